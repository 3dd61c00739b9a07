"""Queries over the words of ``documents``: periodic runs, spelling variants, quality scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.llm import periodic_runs, quality_classifier, spelling_groups
from clausemill.llm.common import let, stored, table, whole, words
from clausemill.llm.registry import query


def _checksum(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def with_echoes(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, in which every tenth document (by checksum) goes on repeating one of its stretches."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def echoed(w: Column) -> Column:
        n, g = F.size(w), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")

        def turning(start: Column, period: Column) -> Column:
            rest = F.transform(F.sequence(F.lit(0), n - start - 1), lambda i: F.get(w, start + i % period))
            return F.array_join(F.concat(F.slice(w, F.lit(1), start), rest), " ")

        return F.when(n > 0, let(a, lambda start: let(p, lambda period: turning(start, period)))).otherwise(F.lit(""))

    text = F.when(h % 10 == 0, let(words(whole("text")), echoed)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The periodic runs of every document, the one with most turns, and the text without the repeats."""
    found = periodic_runs.runs(with_echoes(table(spark, folder, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))

    def more_turns(best: Column, run: Column) -> Column:
        ahead = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(ahead, run).otherwise(best)

    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.reduce("runs", none, more_turns).alias("best"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).selectExpr(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        "1000 * best.length DIV best.period AS exponent_milli",
        "runs_sha256",
        "collapsed_sha256",
    )


# Here the checksum is worked out byte by byte, and near words meet by the words that a deletion at one place leaves.
SPELLING_SQL = f"""
WITH RECURSIVE sums AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
runs AS (
  SELECT doc_id, translate(run, '{spelling_groups.UPPER}', '{spelling_groups.LOWER}') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= {spelling_groups.MIN_LETTERS}),
bytes AS (
  SELECT run, flatten(list_transform(string_split(doc_id::VARCHAR || ':' || run, ''), lambda x:
           CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + unicode(x)::BIGINT // 64, 128 + unicode(x)::BIGINT % 64] END)) AS b
  FROM runs),
marked AS (
  SELECT run, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b),
           lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]))) AS h
  FROM bytes, sums),
slipped AS (
  SELECT CASE WHEN h % {spelling_groups.SLIP} = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2)
         ELSE run END AS word FROM marked),
w AS (SELECT word, count(*) AS n FROM slipped WHERE length(word) >= {spelling_groups.MIN_LETTERS}
      GROUP BY word HAVING count(*) >= {spelling_groups.MIN_COUNT}),
less AS (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b
         FROM (SELECT word, n, unnest(range(length(word)))::INTEGER AS i FROM w)),
pairs AS (
  SELECT x.word AS word, y.word AS other, y.n AS other_n FROM less x JOIN less y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN w ON w.word = l.a || l.b
  UNION SELECT w.word, l.word, l.n FROM less l JOIN w ON w.word = l.a || l.b),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS other_n FROM pairs GROUP BY word),
named AS (SELECT b.word, b.n_near, b.other_n, min(p.other) AS other FROM best b JOIN pairs p ON p.word = b.word AND p.other_n = b.other_n GROUP BY ALL),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= {spelling_groups.RATIO} * n THEN other END AS form, CASE WHEN other_n >= {spelling_groups.RATIO} * n THEN other_n END AS form_n
  FROM w LEFT JOIN named ON named.word = w.word),
ways AS (SELECT word, word AS root, form AS onward FROM forms
         UNION ALL SELECT ways.word, f.word, f.form FROM ways JOIN forms f ON f.word = ways.onward)
SELECT f.word, f.form, ways.root, f.n::BIGINT AS n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM forms f JOIN ways ON ways.word = f.word AND ways.onward IS NULL
"""


@query("op12_spelling_groups", SPELLING_SQL)
def op12_spelling_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every frequent word of the documents with the form that it is a variant of, and that form's root."""
    counted = spelling_groups.counts(table(spark, folder, "documents"))
    return spelling_groups.group(stored(spark, counted, "word-counts"))


@query("op13_quality_classifier")
def op13_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document, learned from the labels of four fifths of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(_checksum("doc_id") % 5 != 0)
    model = quality_classifier.train(docs, labels)
    return quality_classifier.score(docs, model).select(
        F.col("row.doc_id").alias("doc_id"),
        (_checksum("row.doc_id") % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )
