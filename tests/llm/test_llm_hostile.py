"""Inputs of odd shape and great length: results are right, and time grows about in proportion."""

import time

from pyspark.sql import functions as F
from test_llm_operators import DOCS

from clausemill.llm import line_spread, page_wrappers, personal_data


def _seconds(run):
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def test_deeply_nested_pages(spark):
    def page(depth):
        return "<html><body>" + "<div>" * depth + "<article><p>" + "Some words of the article. " * 20 + "</p></article>" + "</div>" * depth + "</body></html>"

    rows = [(1, "https://a.org/1", page(3000)), (2, "https://a.org/2", page(100_000)), (3, "https://b.org/1", page(5))]
    rows += [(4, "https://b.org/2", "<div>" * 50_000 + "</p>" * 50_000), (5, "https://b.org/3", "</div>" * 50_000 + "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in page_wrappers.extract(pages, page_wrappers.infer(pages)).collect()}
    assert found[1] == found[2] == found[3] == " ".join(["Some words of the article."] * 20)
    assert len(found) == 5
    assert _seconds(lambda: page_wrappers.tree(page(100_000))) < 10


def test_long_runs_of_blanks_and_many_shared_lines(spark):
    rows = [(1, "a" + " " * 1_000_000 + "b\nc", "en", "s", 1)]
    out = line_spread.dedup(spark.createDataFrame(rows, DOCS)).first()
    assert out["clean"] == rows[0][1]
    shared = [f"line number {k} that all sites have" for k in range(20_000)]
    docs = spark.createDataFrame([(k, "\n".join([*shared[:10_000], f"own {k}", *shared[10_000:]]), "en", f"s{k}", 1) for k in range(6)], DOCS)
    started = time.perf_counter()
    out = line_spread.dedup(docs).select("row.doc_id", "clean", "n_boilerplate", "kept_whole").collect()
    assert time.perf_counter() - started < 60
    assert sorted((r["doc_id"], r["clean"], r["n_boilerplate"], r["kept_whole"]) for r in out) == [(k, f"own {k}", 20_000, False) for k in range(6)]


def test_long_runs_of_digits(spark):
    texts = ["7" * 1_000_000, "1." * 300_000, "10.0.0.1 and 1.2.3.4.5.6.7.8 and 999.1.1.1 and 12345.1.1.1", "@" * 100_000 + "a@b.c"]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS).select("doc_id", "text")
    started = time.perf_counter()
    found = {r["doc_id"]: r["spans"] for r in personal_data.find(docs).collect()}
    assert time.perf_counter() - started < 60
    of_third = [(s["start"], s["end"]) for s in found[2] if s["kind"] == "ip" and s["base"]]
    assert of_third == [(0, 8), (13, 20), (21, 28)]
