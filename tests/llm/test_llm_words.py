"""Periodic runs, spelling variants and the quality classifier, against plain versions of what they compute."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_llm_operators import DOCS, odd_docs, prose

from clausemill.llm import periodic_runs, quality_classifier, queries_words, spelling_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- periodic runs -----------------------------------------------------------------------------


def plain_runs(x):
    """Every run by comparing the sequence with itself at every distance."""
    found = {}
    for q in range(1, len(x) // 3 + 1):
        at = 0
        while at < len(x) - q:
            end = at
            while end < len(x) - q and x[end] == x[end + q]:
                end += 1
            if end - at + q >= max(24, 3 * q):
                found.setdefault((at, end + q), q)
            at = end + 1
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def pieces(r):
    out = []
    for _ in range(r.randrange(1, 5)):
        period = [r.randrange(r.choice([2, 3, 50])) for _ in range(r.randrange(1, 45))]
        out += (period * r.randrange(1, 9))[: r.randrange(1, 320)]
        out += [r.randrange(4) for _ in range(r.randrange(30))]
    return out


def test_runs_equal_those_of_all_distances():
    for seed in range(250):
        x = pieces(random.Random(seed))
        assert [tuple(run) for run in periodic_runs.find_runs(np.array(x)).tolist()] == plain_runs(x), seed


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120))
def test_runs_of_any_short_sequence(x):
    assert [tuple(run) for run in periodic_runs.find_runs(np.array(x, dtype=np.int64)).tolist()] == plain_runs(x)


def test_a_deceiving_hash_is_found_out(monkeypatch):
    x = np.array(pieces(random.Random(7)) + [9] * 30)
    right = periodic_runs.find_runs(x).tolist()
    monkeypatch.setattr(periodic_runs._Stretches, "_same", lambda self, a, d, size: np.ones(len(a), dtype=bool))
    assert periodic_runs.find_runs(x).tolist() == right


def test_transforms_multiply():
    r = np.random.default_rng(1)
    a, b = (r.integers(0, 1 << 12, (3, 32)).astype(np.uint64) for _ in range(2))
    a[:, 16:] = b[:, 16:] = 0
    t = periodic_runs.Transform(32)
    got = t.back(t.there(a) * t.there(b) % np.uint64(periodic_runs.PRIME))
    for k in range(3):
        assert got[k, :31].tolist() == (np.convolve(a[k, :16].astype(int), b[k, :16].astype(int)) % periodic_runs.PRIME).tolist()


def test_long_runs_grow_nearly_in_proportion():
    for x in (np.zeros(100_000, dtype=int), np.tile(np.arange(20_000), 5)):
        assert len(periodic_runs.find_runs(x)) == 1


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    number = {}
    runs = plain_runs([number.setdefault(w, len(number)) for w in words])
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = None
    for s, e, q in runs:
        if best is None or (e - s) * best[2] > best[1] * q:
            best = (s, e - s, q)
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, kept)]
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digests)


@pytest.fixture
def written(spark, tmp_path):
    def write(docs):
        docs.write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)

    return write


def test_run_query(spark, written):
    rows = [(n, " ".join(f"w{x}" for x in pieces(random.Random(n))), "en", "a", 1) for n in range(120)]
    rows += [(500, "a b   c " * 30, "en", "a", 1), (501, "x " * 3000, "en", "a", 1), (None, "y " * 40, "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS).unionByName(odd_docs(spark).where("doc_id <> 6 OR doc_id IS NULL"))
    folder = written(docs)
    got = [tuple(r) for r in queries_words.op11_periodic_runs(spark, folder).collect()]
    assert sorted(map(str, got)) == sorted(str(plain_row(r["doc_id"], r["text"])) for r in docs.collect())


def test_runs_of_odd_tables(spark):
    found = periodic_runs.runs(odd_docs(spark, clashing=True))
    assert found.count() == 10 and found.where("size(runs) > 0").count() == 0
    assert found.where("row.text IS NULL").first()["collapsed"] == ""
    assert periodic_runs.runs(odd_docs(spark).where("false")).count() == 0


# --- spelling variants -------------------------------------------------------------------------


def plain_groups(n):
    near = {w: set() for w in n}
    for w in n:
        for other in n:
            if w != other and abs(len(w) - len(other)) <= 1:
                short, long = sorted((w, other), key=len)
                same = next((i for i, (a, b) in enumerate(zip(short, long, strict=False)) if a != b), len(short))
                rest = short[same:] if len(short) < len(long) else short[same + 1 :]
                if rest == long[same + 1 :]:
                    near[w].add(other)
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def test_groups_equal_those_of_all_pairs(spark):
    r = random.Random(3)
    bases = ["aaaaaaa", "abababab", "élévation", "straßenbahn", "mississippi", "zzzzzzzzzz", "listening", "silentnig"]
    n = {}
    for base in bases:
        n[base] = 1000
        for _ in range(60):
            w = base
            for _ in range(r.randrange(1, 4)):
                at, c = r.randrange(len(w) + 1), r.choice("abeéßzÿ÷")
                w = r.choice([w[:at] + c + w[at:], w[:at] + c + w[at + 1 :], w[:at] + w[at + 1 :]])
            if len(w) >= 6:
                n[w] = r.choice([2, 5, 20, 99, 100])
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = spelling_groups.group(words).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert {tuple(x) for x in got} == plain_groups(n) and len(got) == len(n)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spelling_groups.near_pairs(words.withColumn("id", F.monotonically_increasing_id()))._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_long_chains_end_at_their_root(spark):
    n = {"abcdefgh" + "x" * k: 10**k for k in range(12)}
    got = {r["word"]: r["root"] for r in spelling_groups.group(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"abcdefgh" + "x" * 11}


def test_word_counts(spark):
    texts = [(k, f"Wordlike, WORDLIKE wordlike! été{'x' * (k % 4)}longue short {prose(k)}") for k in range(300)]
    docs = spark.createDataFrame([(k, t, "en", "a", 1) for k, t in texts], DOCS)
    plain = {}
    for k, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{k}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            plain[low] = plain.get(low, 0) + 1
    plain = {w: n for w, n in plain.items() if len(w) >= 7 and n >= 2}
    assert {r["word"]: r["n"] for r in spelling_groups.counts(docs).collect()} == plain


def test_words_of_odd_tables(spark):
    counted = spelling_groups.counts(odd_docs(spark, clashing=True))
    assert spelling_groups.group(counted).count() == counted.count()
    assert spelling_groups.group(spelling_groups.counts(odd_docs(spark).where("false"))).count() == 0


# --- quality classifier ------------------------------------------------------------------------


def good_and_bad(n):
    r = random.Random(5)
    rows = []
    for k in range(n):
        words = prose(k, r.randrange(5, 120)).split()
        bad = k % 4 == 0
        rows.append((k, " ".join(w.upper() + "!!" if bad and k % 8 else (w + " | ") if bad else w for w in words), 0 if bad else 1))
    return rows


def test_held_out_quality(spark):
    rows = good_and_bad(1200)
    docs = spark.createDataFrame([(k, t, "en", "a", 1) for k, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(k, q, 0) for k, _, q in rows], "doc_id long, quality int, toxic int")
    model = quality_classifier.train(docs, labels.where("doc_id % 5 <> 0"))
    scores = {r["row"]["doc_id"]: r["score"] for r in quality_classifier.score(docs, model).collect()}
    held = [(scores[k], q) for k, _, q in rows if k % 5 == 0]
    assert sum((s >= quality_classifier.THRESHOLD) == bool(q) for s, q in held) > 0.97 * len(held)
    again = quality_classifier.train(docs.repartition(7), labels.where("doc_id % 5 <> 0").repartition(3))
    assert again.first() == model.first()
    few = quality_classifier.train(docs, labels, max_examples=50)
    assert few.first() != model.first()


def test_scores_of_odd_tables(spark):
    docs = odd_docs(spark, clashing=True)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 1), (None, 1, 0), (99, 0, 0), (5, 0, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.train(docs, labels)
    scores = quality_classifier.score(docs, model).collect()
    assert len(scores) == 10 and all(0 <= r["score"] <= 1 for r in scores)
    by_text = {}
    for r in scores:
        by_text.setdefault(r["row"]["text"] or "", set()).add(r["score"])
    assert all(len(found) == 1 for found in by_text.values())
    nothing = quality_classifier.train(docs, labels.where("false"))
    assert {r["score"] for r in quality_classifier.score(docs, nothing).collect()} == {0.5}
    assert quality_classifier.score(docs.where("false"), model).count() == 0


def test_features_of_long_and_odd_texts():
    features = quality_classifier.Features()
    assert len(features.of(None)[0]) == len(features.of("")[0]) == 0
    for text in ("x", " ", "a" * 2_500_000, "ä€😀 " * 300_000):
        places, values = features.of(text)
        assert len(places) == len(set(places.tolist())) and (not len(values) or abs(float(values @ values) - 1) < 1e-9)
