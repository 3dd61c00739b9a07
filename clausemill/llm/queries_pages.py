"""Queries over ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.llm import page_wrappers, url_rules, warc_archives
from clausemill.llm.common import table
from clausemill.llm.registry import query

WARC_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {warc_archives.MIN_SHARED_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {warc_archives.MIN_SHARED_BYTES} AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query("op4_warc", WARC_SQL)
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives and read back through their index.

    Digest and bytes of a response are those of the payload that was read.
    """
    archives = warc_archives.archive_folder(spark)
    index = warc_archives.write(table(spark, folder, "pages"), archives)
    return warc_archives.read(index, archives).select(
        F.col("record_id").alias("page_id"),
        "payload_bytes",
        F.coalesce(F.sha2("payload", 256), "payload_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


# The rules of the query, as (verdict, host, path).
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
_FITS = " ".join(
    f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{{{at}}}'"
    for at, (_, host, path) in sorted(enumerate(URL_RULES), key=lambda x: (-len(x[1][1]), -len(x[1][2])))
)
_HIT_RULE = _FITS.format(*(host + path for _, host, path in URL_RULES))
_HIT_VERDICT = _FITS.format(*(verdict for verdict, _, _ in URL_RULES))
URL_SQL = f"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages)
SELECT page_id, host, path, CASE {_HIT_RULE} END AS rule,
       CASE {_HIT_VERDICT}
            WHEN host = '' OR regexp_matches(host, '(^|[.-])({"|".join(url_rules.BLOCKED_WORDS)})([.-]|$)') THEN 'block'
            ELSE 'allow' END AS verdict
FROM parts
"""


@query("op10_url_rules", URL_SQL)
def op10_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's URL."""
    rules = spark.createDataFrame([(host, path, verdict) for verdict, host, path in URL_RULES], url_rules.RULES)
    return url_rules.judge(table(spark, folder, "pages").select("page_id", "url"), rules)


# On these tables an article element holds the text; SQL reads it by patterns.
ARTICLE_SQL = """
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*)</article>', 1) AS body FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(body, '</?(?:p|h[1-6]|div|br|ul|ol|li)\\b[^>]*>', ' ', 'g'), '<[^>]*>', '', 'g') AS body FROM a),
c AS (SELECT page_id, url, replace(replace(replace(replace(replace(body, '&quot;', '"'), '&#x27;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS body FROM b),
d AS (SELECT page_id, url, trim(regexp_replace(body, '[\\s]+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM d
"""


@query("op6_page_wrappers", ARTICLE_SQL)
def op6_page_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    """The article of every page, read with its host's wrapper."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return page_wrappers.extract(pages, page_wrappers.infer(pages))
