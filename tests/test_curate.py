import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clausemill.functions.ids import SPLIT_SEED, ambiguity_score, clause_id, filing_year, split_bucket, split_point
from clausemill.functions.taxonomy import CONTRACT_LABELS
from clausemill.operators import checks as U
from clausemill.operators import curate as C


def test_split_is_the_digest_modulo_ten_thousand(spark):
    keys = [str(n) for n in range(2000)] + ["0000320193", "ü", ""]
    got = spark.createDataFrame([(k,) for k in keys], "cik string").select("cik", split_point("cik").alias("p"), split_bucket(F.col("cik")).alias("b"))
    for row in got.collect():
        point = int(hashlib.sha256(f"{SPLIT_SEED}:{row['cik']}".encode()).hexdigest(), 16) % 10000
        assert row["p"] == point
        assert row["b"] == ("train" if point < 7000 else "val" if point < 8500 else "test")


def test_identifiers(spark):
    rows = spark.createDataFrame(
        [("0001493152-23-002944", "a.htm", "Termination", "T"), ("0001493152-2023-002944", "a.htm", "x", "y"), ("a-1b-c", "", "", ""), ("a-23", "", "", "")],
        "accession string, filename string, label string, section_header string",
    )
    got = rows.select(filing_year(F.col("accession")).alias("year"), clause_id().alias("id")).collect()
    assert [r["year"] for r in got] == ["2023", None, None, None]
    assert got[0]["id"] == hashlib.sha1(b"0001493152-23-002944:a.htm:Termination:T").hexdigest()


def test_ambiguity_score(spark):
    rows = [
        ("Termination", 500, 1),  # bare
        ("TERMINATION.:", 59, 2),  # bare and short
        ("Indemnification; Limitation of Liability; Termination", 60, 2),  # three categories
        ("Miscellaneous", 500, -1),
        (" Payment ", 500, 1),
    ]
    got = spark.createDataFrame(rows, "h string, n int, expected int").select("h", "expected", ambiguity_score(F.col("h"), F.col("n")).alias("score"))
    for row in got.collect():
        assert row["score"] == row["expected"], row


def _clauses(rng, count, companies):
    # One company holds a third of the rows.
    return [
        (f"id{n}", "hot" if rng.random() < 0.33 else f"c{rng.randrange(companies)}", rng.choice(CONTRACT_LABELS + ["Other"]))
        for n in range(count)
    ]


def _assert_greedy(rows, picked, per_category, cap):
    """A row is picked exactly if, when its turn comes, its label and its company still have room."""
    key = {i: hashlib.sha256(f"42:{i}".encode()).hexdigest() for i, _, _ in rows}
    turn = {label: at for at, label in enumerate(CONTRACT_LABELS)}
    assert all(n <= cap for n in Counter(cik for i, cik, _ in rows if i in picked).values())
    assert all(n <= per_category for n in Counter(label for i, _, label in rows if i in picked).values())
    assert picked <= {i for i, _, label in rows if label in turn}
    for identifier, cik, label in rows:
        if label not in turn or identifier in picked:
            continue
        earlier = [(c, x) for i, c, x in rows if i in picked and (turn[x], key[i], i) < (turn[label], key[identifier], identifier)]
        full = sum(x == label for _, x in earlier) == per_category
        assert full or sum(c == cik for c, _ in earlier) == cap


@pytest.mark.parametrize("seed, count, companies, per_category, cap", [(1, 400, 20, 5, 3), (2, 60, 3, 4, 2), (3, 500, 6, 30, 1), (4, 300, 100, 100, 10), (5, 0, 1, 5, 5)])
def test_sample_is_greedy(spark, seed, count, companies, per_category, cap):
    rows = _clauses(random.Random(seed), count, companies)
    clauses = spark.createDataFrame(rows, "clause_id string, cik string, label string").repartition(4)
    picked = {r["clause_id"] for r in C.sample_picks(clauses, per_category, cap).collect()}
    _assert_greedy(rows, picked, per_category, cap)
    sample = C.stratified_sample(clauses, per_category, cap)
    assert {r["clause_id"] for r in sample.collect()} == picked
    short = {r["label"]: (r["wanted"], r["found"]) for r in C.shortfall(spark, sample, per_category).collect()}
    assert len(short) == 10 and sum(found for _, found in short.values()) == len(picked)


def test_sample_does_not_depend_on_partitioning(spark):
    rows = _clauses(random.Random(5), 400, 20)
    clauses = spark.createDataFrame(rows, "clause_id string, cik string, label string")
    picks = [sorted(r["clause_id"] for r in C.sample_picks(clauses.repartition(n), 6, 2).collect()) for n in (1, 7)]
    assert picks[0] == picks[1]


def test_gates(spark):
    sets = spark.createDataFrame([("train", "1"), ("train", "2"), ("val", "2"), ("eval", "3"), ("eval", "4")], "set string, cik string")
    assignments = spark.createDataFrame([("1", "train"), ("2", "train"), ("3", "test"), ("9", "other"), ("8", None)], "cik string, bucket string")
    assert [r["cik"] for r in U.shared_companies(sets).collect()] == ["2"]
    assert sorted(r["cik"] for r in U.unknown_buckets(assignments).collect()) == ["8", "9"]
    assert sorted((r["set"], r["cik"]) for r in U.misplaced(sets, assignments).collect()) == [("eval", "4"), ("val", "2")]
    labels = spark.createDataFrame([("Termination",), ("Odd",), ("Odd",)], "label string")
    assert [tuple(r) for r in U.labels_outside(labels).collect()] == [("Odd", 2)]
