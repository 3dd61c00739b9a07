"""The corpus pipeline against a plain version on a small fixture."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_llm_operators import DOCS, plain_components, prose

from clausemill.llm import line_spread, piece_sampling


def _documents():
    r = random.Random(1)
    shared = "Visit the mill of the valley on a sunny day."
    texts = []
    for i in range(40):
        text = prose(i, 120)
        if i % 4 == 0:
            text = f"{text}\n{shared}\n{prose(500 + i, 60)}"
        texts.append(text)
        if i % 5 == 0:  # near and exact copies
            words = text.split(" ")
            words[3] = "changed"
            texts += [" ".join(words), text]
        if i % 7 == 0:
            texts.append(" | ".join(prose(900 + i, 70).split()))
        if i % 11 == 0:
            texts += ["too short to stay.", None, ""]
    return [(i, t, "en", f"src{r.randrange(8)}", len(t or "")) for i, t in enumerate(texts)]


def _plain(rows):
    """Kept ids and texts: pipes and short texts go, the shared line goes, one of each group stays."""
    kept = [(i, t, s) for i, t, _, s, _ in rows if t and len(re.findall(r"\S+", t)) >= 50 and " | " not in t]
    sites = defaultdict(set)
    for _, t, s in kept:
        for line in t.split("\n"):
            sites[line].add(s)
    cleaned = []
    for i, t, _ in kept:
        lines = t.split("\n")
        left = [x for x in lines if len(sites[x]) < line_spread.MIN_SITES]
        cleaned.append((i, "\n".join(left) if "".join(left).strip() else t))
    heads = [c for _, c in plain_components([t for _, t in cleaned])]
    return {i: t for at, (i, t) in enumerate(cleaned) if heads[at] == at}


@pytest.fixture(scope="module")
def folder_of_documents(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(_documents(), DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_run_against_a_plain_version(spark, folder_of_documents):
    out = corpus_pipeline.run(spark, folder_of_documents)
    texts = out.select("doc_id", "lossless", piece_sampling.decode(F.col("pieces"), piece_sampling.Vocabulary()).alias("t")).collect()
    assert {r.doc_id: r.t for r in texts} == _plain(_documents())
    assert all(r.lossless for r in texts) and len(texts) == len({r.doc_id for r in texts})


def test_stages_return_the_columns_of_documents(spark, folder_of_documents):
    docs = spark.read.parquet(f"{folder_of_documents}/documents.parquet")
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, folder_of_documents)
        assert docs.columns == columns
        rows = docs.collect()
        assert all(r.n_chars == len(r.text) for r in rows)
        sizes.append(Counter(r.source for r in rows).total())
        docs = spark.createDataFrame(rows, DOCS)
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2]
