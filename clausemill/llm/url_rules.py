"""URL filters by a sort-merge range join (operator 10).

A rule names a host and a path prefix; it fits the host, all its subdomains and every path with that prefix. With
the labels of a host reversed and closed by dots (``org.example.``), a rule's hosts are one interval of sorted keys,
and intervals nest or are disjoint. URLs are sorted by that key; a sweep over both keeps the rules whose interval
it is in on a stack, innermost on top, and asks the stack from the top for a path prefix. So the longest host
decides, then the longest path.

The sorted order is cut into ranges at sampled keys, so the sweep runs in parallel; a rule is sent to every range
that its interval meets. The sample only balances the ranges, and as cuts also take the row's own key into account,
a host or a URL with a third of all rows is cut as well.

A URL without ``://`` or a null one has an empty host and path. Where no rule fits, the URL is blocked if it has no
host or a word of its host is on the list below, else allowed. Repeated rows and ids are judged one by one.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Host words that block where no rule decides.
BLOCKED_WORDS = "casino gambling malware phishing pills porn spam viagra warez xxx".split()
CUTS_PER_PARTITION = 2
SAMPLE_PER_CUT = 50
CUT_CHARS = 200  # a cut is any string, so a long key may be shortened to make one

RULES = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, with A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """The labels of a host from the last to the first, each closed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def default_verdict(host: Column) -> Column:
    """The verdict where no rule fits."""
    listed = host.rlike(r"(^|[.-])(" + "|".join(BLOCKED_WORDS) + r")([.-]|$)")
    return F.when((host == "") | listed, "block").otherwise("allow")


def _cuts(urls: DataFrame, ranges: int) -> list[tuple[str, str, int]]:
    """At most ``ranges - 1`` keys that divide the URLs evenly, from a bounded sample."""
    wanted = ranges * SAMPLE_PER_CUT
    total = urls.count()
    keys = urls.select(F.substring("reversed", 1, CUT_CHARS), F.substring("path", 1, CUT_CHARS), "salt")
    if total > wanted:
        keys = keys.sample(fraction=min(1.0, 1.2 * wanted / total), seed=7)
    sample = sorted(tuple(row) for row in keys.limit(2 * wanted).collect())
    return sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)}) if sample else []


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """URLs with the rule that decides, from rows sorted by range and reversed host, rules first."""
    current, stack = None, []
    for batch in batches:
        out = []
        for at, key, host, path, verdict, row in zip(
            batch["range"], batch["reversed"], batch["host"], batch["path"], batch["verdict"], batch["row"], strict=True
        ):
            if at != current:
                current, stack = at, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if verdict is not None:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}))
                # Of two equal rules the one that sorts last holds; "block" follows "allow".
                stack[-1][1].setdefault(len(path), {})[path] = (f"{host}{path}", verdict)
                continue
            found = (None, None)
            for _, by_length in reversed(stack):
                hits = (by_length[n].get(path[:n]) for n in sorted(by_length, reverse=True) if n <= len(path))
                if hit := next((h for h in hits if h), None):
                    found = hit
                    break
            out.append((row, host, path, *found))
        yield pd.DataFrame(out, columns=["row", "host", "path", "rule", "verdict"])


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", key: str = "page_id") -> DataFrame:
    """Each row's ``key`` with ``host``, ``path``, the deciding ``rule`` (or null) and ``verdict``.

    ``rules`` has the columns host, path and verdict (allow or block); it may be of any size.
    """
    spark = urls.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = partitions * CUTS_PER_PARTITION
    keyed = urls.select(F.col(key).alias("row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    keyed = keyed.withColumns({"reversed": reversed_host(F.col("host")), "salt": F.xxhash64("row")})
    cuts = _cuts(keyed, ranges)

    def of_range(reversed_: pd.Series, path: pd.Series, salt: pd.Series) -> pd.Series:
        places = (bisect.bisect_right(cuts, k) for k in zip(reversed_, path, salt, strict=True))
        return pd.Series(list(places), dtype="int32", index=reversed_.index)

    lowest, highest = -(2**63), 2**63 - 1
    range_of = F.pandas_udf(of_range, "int")
    known = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IN ('allow', 'block')").withColumn(
        "reversed", reversed_host(F.col("host"))
    )
    # The dot that closes an interval's keys is followed by the slash.
    after = F.concat(F.expr("left(reversed, length(reversed) - 1)"), F.lit("/"))
    first = range_of("reversed", F.lit(""), F.lit(lowest))
    last = range_of(after, F.lit(""), F.lit(lowest))
    known = known.select(
        "reversed", "host", "path", "verdict", F.lit(None).cast(keyed.schema["row"].dataType).alias("row"), first.alias("a"), last.alias("b")
    )
    known = known.select("*", F.explode(F.sequence("a", "b")).alias("range")).drop("a", "b")
    rows = keyed.withColumn("range", range_of("reversed", "path", "salt")).withColumn("verdict", F.lit(None).cast("string"))
    dealt = (
        rows.drop("salt")
        .unionByName(known)
        .repartition(partitions, "range")
        .sortWithinPartitions("range", "reversed", F.col("verdict").isNull(), "path", "verdict")
    )
    kind = keyed.schema["row"].dataType.simpleString()
    judged = dealt.mapInPandas(_sweep, f"row {kind}, host string, path string, rule string, verdict string")
    return judged.select(
        F.col("row").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", default_verdict(F.col("host"))).alias("verdict"),
    )
