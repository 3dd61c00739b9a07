"""Queries over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.llm import chosen_path, line_spread, mixing, personal_data, piece_sampling
from clausemill.llm import quality_rules as quality
from clausemill.llm.common import table
from clausemill.llm.registry import query

# The same rules in SQL; there the repeated windows are found by joining windows that are compared as strings.
_LINE_FAILS = f"""(len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) > 0 AND (
    NOT regexp_matches(line, '{quality.SIGN}')
    OR len(regexp_extract_all(line, '{quality.MARKED_WORD}')) * 3 >= len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'))
    OR (len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) <= 2
        AND NOT regexp_matches(line, '{quality.ENDS_WELL.replace("'", "''")}'))
    OR (len(regexp_extract_all(line, '{quality.SEPARATOR}')) > 0
        AND len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) - len(regexp_extract_all(line, '{quality.SEPARATOR}'))
            <= {quality.ITEM_WORDS} * (len(regexp_extract_all(line, '{quality.SEPARATOR}')) + 1))
    OR regexp_matches(line, '{quality.MENU_LINE}')
    OR (len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) <= {quality.STOCK_LINE_WORDS}
        AND regexp_matches(line, '{quality.STOCK_PHRASE}'))))"""

QUALITY_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
grams AS (
  SELECT doc_id, pos, list_slice(ws, pos, pos + 2) AS gram
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS pos FROM w WHERE len(ws) >= 3)),
again AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS p FROM again WHERE n >= 2) GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, {_LINE_FAILS} AS failed, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS has_word
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
by_doc AS (
  SELECT doc_id, count(*) FILTER (has_word) - count(DISTINCT line) FILTER (has_word) AS n_dup_lines,
         count(*) FILTER (failed) AS n_failed_lines,
         coalesce(sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) FILTER (failed), 0) AS lost_chars
  FROM lines GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         n_dup_lines::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         n_failed_lines::BIGINT AS n_failed_lines, lost_chars::BIGINT AS lost_chars
  FROM w JOIN by_doc USING (doc_id) LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND NOT lost_chars * 100 > word_chars * {quality.MAX_LOST_PERCENT} AS kept FROM b
"""


@query("op1_quality_rules", QUALITY_SQL)
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict of every document."""
    judged = quality.judge(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.selectExpr(
        "row.doc_id AS doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_failed_lines",
        "lost_chars",
        "base_failed",
        "kept",
    )


# The target weights of the sources, in parts; every other source shares the last entry.
TARGET_PARTS: dict[str | None, int] = {
    "src0": 10,
    **{f"src{k}": 4 for k in range(1, 10)},
    **{f"src{k}": 2 for k in range(10, 20)},
    None: 1,
}
_NAMES = [name for name in TARGET_PARTS if name is not None]
_PARTS, _TOTAL = list(TARGET_PARTS.values()), sum(TARGET_PARTS.values())

# Here the period is scheduled by recursion and the final order by one sort.
MIXING_SQL = f"""
WITH RECURSIVE params AS (SELECT {_PARTS}::BIGINT[] AS p),
state AS (
  SELECT 0::BIGINT AS slot, list_transform(p, lambda x: 0::BIGINT) AS done FROM params
  UNION ALL
  SELECT slot + 1, list_transform(done, lambda n, i: n + (i = pick)::BIGINT)
  FROM (SELECT slot, done, list_min(list_transform(
            list_filter(range(1, {len(_PARTS) + 1}), lambda m: done[m] < p[m] AND (done[m] * {_TOTAL}) // p[m] <= slot),
            lambda m: {{'d': ((done[m] + 1) * {_TOTAL} + p[m] - 1) // p[m], 'm': m}}))['m'] AS pick
        FROM state, params WHERE slot < {_TOTAL})),
period AS (
  SELECT a.slot, m - 1 AS member, a.done[m] AS k, (a.done[m] * {_TOTAL}) // p[m] AS release,
         ((a.done[m] + 1) * {_TOTAL} + p[m] - 1) // p[m] AS deadline
  FROM state a JOIN state b ON b.slot = a.slot + 1, params, unnest(range(1, {len(_PARTS) + 1})) AS t(m)
  WHERE b.done[m] > a.done[m]),
ranked AS (
  SELECT doc_id, source, member, p[member + 1] AS p,
         row_number() OVER (PARTITION BY member ORDER BY md5('mix:' || coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST) - 1 AS rank
  FROM (SELECT doc_id, source, coalesce(list_position({_NAMES}, source) - 1, {len(_NAMES)}) AS member FROM documents), params),
placed AS (
  SELECT doc_id, source, rank, rank // {mixing.BLOCK_ROWS} AS block,
         (rank // {mixing.BLOCK_ROWS} // p) * {_TOTAL} AS base, s.release, s.deadline, s.slot
  FROM ranked JOIN period s ON s.member = ranked.member AND s.k = (rank // {mixing.BLOCK_ROWS}) % p)
SELECT doc_id, source, rank::BIGINT AS rank, block::BIGINT AS block, (base + release)::BIGINT AS release,
       (base + deadline)::BIGINT AS deadline, (base + slot)::BIGINT AS slot,
       (row_number() OVER (ORDER BY base + slot, rank) - 1)::BIGINT AS position
FROM placed
"""


@query("op3_mixing", MIXING_SQL)
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every document in a mix with the target weights."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mixing.mix(docs, TARGET_PARTS).selectExpr(
        "row.doc_id AS doc_id", "row.source AS source", "CAST(rank AS BIGINT) AS rank", "block", "release", "deadline", "slot", "position"
    )


LINE_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, source, text, pos, line, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d)),
common AS (
  SELECT bare FROM lines WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= {line_spread.MIN_SITES}),
marked AS (SELECT l.*, c.bare IS NOT NULL AS gone,
                  length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars
           FROM lines l LEFT JOIN common c ON c.bare = l.bare),
by_doc AS (
  SELECT doc_id, any_value(text) AS text, count(*) FILTER (gone) AS n_boilerplate,
         coalesce(sum(chars) FILTER (gone), 0) AS boilerplate_chars, sum(chars) AS chars,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS rest
  FROM marked GROUP BY doc_id)
SELECT doc_id, n_boilerplate::BIGINT AS n_boilerplate, boilerplate_chars::BIGINT AS boilerplate_chars,
       n_boilerplate > 0 AND boilerplate_chars = chars AS kept_whole,
       CASE WHEN n_boilerplate = 0 OR boilerplate_chars = chars THEN text ELSE rest END AS text
FROM by_doc
"""


@query("op7_line_spread", LINE_SQL)
def op7_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that stand on many sites, unless it has no other."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return line_spread.dedup(docs).selectExpr(
        "row.doc_id AS doc_id", "n_boilerplate", "boilerplate_chars", "kept_whole", "clean AS text"
    )


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """A sampled segmentation of every document, and whether it decodes to the text."""
    return piece_sampling.encode(table(spark, folder, "documents").select("doc_id", "text"))


@query("op9_personal_data")
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """The personal data of every document: base spans by kind, and all spans."""
    found = personal_data.find(table(spark, folder, "documents").select("doc_id", "text"))

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in personal_data.BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )


# Here all pairs with a shingle in common are compared, and components grow by recursion.
NEAR_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d),
k AS (SELECT s AS ks, min(doc_id) AS id, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM g) WHERE len(s) > 0 GROUP BY s),
e AS (SELECT id, n, hash(unnest(ks)) AS x FROM k),
pairs AS (SELECT a.id AS a, b.id AS b FROM e a JOIN e b ON a.x = b.x AND a.id < b.id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
          GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
sym AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT id, id AS r FROM k UNION SELECT reach.id, sym.b FROM reach JOIN sym ON sym.a = reach.r),
c AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
SELECT g.doc_id, len(g.s)::BIGINT AS n_shingles, coalesce(c.component_id, g.doc_id) AS component_id,
       coalesce(c.component_id, g.doc_id) = g.doc_id AS kept
FROM g LEFT JOIN k ON k.ks = list_sort(g.s) LEFT JOIN c ON c.id = k.id
"""


@query("op8_chosen_path", NEAR_SQL)
def op8_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's component of near copies."""
    return chosen_path.link(table(spark, folder, "documents").select("doc_id", "text"))
