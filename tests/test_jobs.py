import datetime
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from clausemill.catalog import curation, profiling, star  # noqa: F401  (they register their queries)
from clausemill.catalog.registry import QUERIES
from clausemill.operators.curate import assign_buckets
from clausemill.operators.enrich import ENRICHED_COLUMNS
from clausemill.operators import extract as extract_module
from clausemill.operators.extract import extract, extract_listed, with_lines
from clausemill.plans.corpus import build_corpus, label_report
from clausemill.plans.dataset import LeakError, SetSizes, build_dataset, check_sets
from clausemill.plans.store import build_store, check_store
from clausemill.sources import exhibits, indexes, schemas, tables
from clausemill.streaming.ingest import append_clauses, stream_exhibits

BODY = b"The parties agree to the terms that are set out in this section."


def _write(folder, cik, accession, name, *lines):
    place = folder / cik / accession
    place.mkdir(parents=True, exist_ok=True)
    (place / name).write_bytes(b"<TYPE>EX-10\n<TEXT>" + b"".join(b"<p>" + line + b"</p>" for line in lines))


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    _write(folder, "1", "0000000001-23-000001", "a b%20c.htm", b"Termination", BODY, b"bad \xff byte")
    _write(folder, "1", "0000000001-23-000002", "x.htm", b"nothing here")
    _write(folder, "2", "0000000002-23-000001", "y.htm", b"5.", b"GOVERNING LAW", BODY, b"6. Payment", BODY)
    _write(folder, "3", "0000000003-23-000001", "unfinished.htm", b"Termination", BODY)
    (folder / "too-high.htm").write_bytes(b"<p>Termination</p><p>" + BODY + b"</p>")
    (folder / "1" / "0000000001-23-000001" / "other.txt").write_bytes(b"no exhibit")
    return str(folder)


def _manifest(spark):
    rows = [
        ("0000000001-23-000001", "a b%20c.htm", "1", "One", "8-K", "EX-10", "done", None),
        ("0000000001-23-000002", "x.htm", "1", "One", "8-K", "EX-10", "done", None),
        ("0000000002-23-000001", "y.htm", "2", "Two", "10-K", "EX-10.1", "done", None),
        ("0000000003-23-000001", "unfinished.htm", "3", "Three", "10-K", "EX-10.1", "failed", None),
    ]
    return spark.createDataFrame(rows, schemas.MANIFEST)


def test_files(spark, raw):
    rows = {(r["cik"], r["accession"], r["filename"]): r["raw"] for r in exhibits.read_exhibits(spark, raw).collect()}
    assert len(rows) == 4
    assert "bad � byte" in rows["1", "0000000001-23-000001", "a b%20c.htm"]
    assert exhibits.read_exhibits_anywhere(spark, raw).count() == 5


def test_files_are_listed_by_tasks(spark, tmp_path):
    """The same files as Spark's own index has, none of which the driver knows."""
    folder = tmp_path / "raw"
    names = ["1/a/x.htm", "1/a/b c%20d.htm", "1/a/_hidden.htm", "1/a/_k=v.htm", "1/a/.dot.htm", "1/a/x.HTM", "1/a/x.txt", "1/a/deep/y.htm", "_2/b/x.htm", "12/c/é.htm", "top.htm", "3/z.htm", "4/_d/w.htm", "[5]/e/v.htm"]
    for name in names:
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(name.encode() + b" \xff")
    (folder / "1/a/empty.htm").touch()
    (folder / "6").mkdir()
    raw = str(folder)
    for companies in ("*", "1*", "[13]", "{1,_2}", "?"):
        found, own = exhibits.read_exhibits(spark, raw, companies), spark.read.format("binaryFile").load(f"{raw}/{companies}/*/*.htm")
        assert not any(file.endswith(".htm") for file in found.inputFiles())
        want = {(*r["path"].split("/")[-3:], r["content"].decode(errors="replace")) for r in own.collect()}
        assert {tuple(r) for r in found.collect()} == want and want
        listed = exhibits.list_exhibits(spark, raw, companies)
        assert {tuple(r) for r in listed.collect()} == {(*r["path"].split("/")[-3:], r["length"]) for r in own.collect()}
        assert not any(file.endswith(".htm") for file in listed.inputFiles())
    found = exhibits.read_exhibits_anywhere(spark, raw)
    own = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.htm").load(raw)
    assert {tuple(r) for r in found.collect()} == {(r["path"], r["content"].decode(errors="replace")) for r in own.collect()}
    assert not any(file.endswith(".htm") for file in found.inputFiles())


def test_packed_files(spark, raw, tmp_path):
    out = str(tmp_path / "packed")
    for _ in range(2):
        exhibits.pack_exhibits(spark, raw, out, ["1*", "[2-9]*"])
    packed = spark.read.parquet(out)
    assert sorted(packed.select("cik", "filename", "raw").collect()) == sorted(exhibits.read_exhibits(spark, raw).select("cik", "filename", "raw").collect())


def test_corpus_job(spark, raw, tmp_path):
    result = build_corpus(spark, raw, _manifest(spark), str(tmp_path / "corpus"))
    assert (result.clauses, result.failed) == (3, 0)
    corpus = tables.read_corpus(spark, result.clauses_path)
    assert sorted((r["label"], r["section_header"], r["company"], r["filing_year"]) for r in corpus.collect()) == [
        ("Governing Law", "GOVERNING LAW", "Two", "2023"),
        ("Payment Terms", "6. Payment", "Two", "2023"),
        ("Termination", "Termination", "One", "2023"),
    ]


def _nodes(plan):
    yield plan.nodeName()
    children = plan.children()
    for at in range(children.size()):
        yield from _nodes(children.apply(at))


def test_only_completed_files_are_opened(spark, raw, monkeypatch):
    listed = exhibits.list_exhibits(spark, raw)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan
    sizes = {r["filename"]: r["length"] for r in listed.collect()}
    assert len(sizes) == 4 and sizes["x.htm"] == os.path.getsize(f"{raw}/1/0000000001-23-000002/x.htm")
    found = extract_listed(spark, raw, _manifest(spark))
    # Gone after it was listed: not opened, so not missed.
    other = listed.where("filename <> 'y.htm'").withColumn("length", F.when(F.col("cik") == "3", 1 << 40).otherwise(F.col("length")))
    texts = {r["filename"]: r["raw"] for r in exhibits.read_listed(other, raw, 1 << 20).collect()}
    assert texts["unfinished.htm"] is None and "bad \ufffd byte" in texts["a b%20c.htm"] and "y.htm" not in texts
    os.remove(f"{raw}/3/0000000003-23-000001/unfinished.htm")
    assert {r["filename"] for r in found.collect()} == {"a b%20c.htm", "y.htm"}
    assert not any("Join" in name for name in _nodes(found._jdf.queryExecution().sparkPlan()))  # neither HTML nor clauses
    monkeypatch.setattr(exhibits, "READ_BYTES", 1)
    again = exhibits.read_listed(exhibits.list_exhibits(spark, raw), raw, 1 << 20).collect()
    assert sorted(r["raw"] for r in again) == sorted(r["raw"] for r in exhibits.read_exhibits(spark, raw, "[12]").collect())


def test_a_file_over_the_budget_is_one_failed_row(spark, raw, monkeypatch):
    monkeypatch.setattr(extract_module, "MAX_BYTES", 100)
    rows = {r["filename"]: r["error"] for r in extract_listed(spark, raw, _manifest(spark)).collect()}
    assert rows["y.htm"].startswith("TooLarge: ") and "x.htm" not in rows


def test_no_files_are_no_rows(spark, raw):
    assert extract_listed(spark, raw, _manifest(spark).where("status = 'lost'")).count() == 0


def test_corpus_job_keeps_failures_apart(spark, tmp_path):
    documents = spark.createDataFrame(
        [("1", "0000000001-23-000001", "a b%20c.htm", None), ("2", "0000000002-23-000001", "y.htm", "<p>Termination</p><p>" + BODY.decode())],
        "cik string, accession string, filename string, raw string",
    )
    result = build_corpus(spark, documents, _manifest(spark), str(tmp_path / "corpus"))
    assert (result.clauses, result.failed) == (1, 1)
    failed = spark.read.parquet(result.failed_path)
    assert [(r["accession"], r["error"].split(":")[0]) for r in failed.collect()] == [("0000000001-23-000001", "TypeError")]


def test_label_report(spark, raw):
    frequencies, gate, scanned = label_report(spark, raw)
    assert {r["label"]: r["n"] for r in frequencies.collect() if r["n"]} == {"Termination": 3, "Governing Law": 1, "Payment Terms": 1}
    assert gate.first()["verdict"] == "FAIL" and gate.first()["missing"].startswith("Indemnification, Limitation of Liability, Confidentiality")
    assert scanned.first().asDict() == {"documents": 5, "without_clauses": 1, "clauses": 5}


def test_store_and_dataset_jobs(spark, folder, tmp_path):
    corpus = star.clauses(spark, folder)
    path = str(tmp_path / "store")
    result = build_store(corpus, star.companies(spark, folder), star.filing_dates(spark, folder), path, load_order=star.LOAD_ORDER)
    assert result.rows == corpus.count() and result.refused == 0
    store = tables.read_store(spark, path)
    assert sorted(store.select("clause_id", "text_len").collect()) == sorted(star.store(spark, folder).select("clause_id", "text_len").collect())
    counts, top, _ = check_store(spark, path, store)
    assert counts.first()["agree"] and top.count() == 10

    out = str(tmp_path / "curated")
    sizes = SetSizes(20, 4, 6, 2, 4)
    result = build_dataset(spark, store, out, sizes)
    totals = {r["set"]: r["examples"] for r in result.report.collect() if r["label"] == "(all)"}
    assert set(totals) == {"train", "val"} and totals["train"] <= 200 and totals["val"] <= 60 and min(totals.values()) > 0
    assert {r["set"]: 0 for r in result.shortfall.collect()} == {"train": 0, "val": 0}
    candidates = tables.read_json_lines(spark, f"{out}/eval_candidates.jsonl", schemas.CANDIDATES)
    picks = candidates.orderBy("clause_id").limit(5).select("clause_id")
    again = str(tmp_path / "again")
    recorded = assign_buckets(store, "another seed")
    moved = build_dataset(spark, store, again, sizes, assignments=recorded, picked_ids=picks)
    assert {r["set"] for r in moved.report.collect()} <= {"train", "val", "eval"}
    train = tables.read_json_lines(spark, f"{again}/train.jsonl").select("cik").distinct().join(recorded, "cik")
    assert [r["bucket"] for r in train.select("bucket").distinct().collect()] == ["train"]
    third = build_dataset(spark, store, str(tmp_path / "third"), sizes, picked_ids=picks)
    assert [r["examples"] for r in third.report.collect() if (r["set"], r["label"]) == ("eval", "(all)")] == [5]
    lines = [json.loads(line) for part in (tmp_path / "curated" / "train.jsonl").glob("part-*") for line in part.read_text().splitlines()]
    assert len(lines) == totals["train"] and all(set(schemas.ENRICHED.replace(",", "").split()[::2]) == set(line) for line in lines)
    with pytest.raises(LeakError):
        check_sets(store.select(F.lit("train").alias("set"), "clause_id", "cik", "label"), assign_buckets(store))


def test_filing_index_files(spark, tmp_path):
    def line(form, company, cik="1", accession="0000000001-23-000001"):
        return f"{form:<12}{company:<40}  {cik:<10}  2023-10-02  edgar/data/{cik}/{accession}.txt"

    head = ["Description: Master Index", "", "Form Type   Company Name   CIK   Date Filed   File Name", "-" * 80]
    for year, quarter, lines in [(2023, 4, [line("10-K", "B Co"), line("10-K/A", "A Co"), line("8-K", "C  Co"), line("8-K", "D Co", "7", "z")]), (2023, 3, [line("S-1", "E Co")])]:
        place = tmp_path / str(year) / f"QTR{quarter}"
        place.mkdir(parents=True)
        (place / "form.idx").write_text("\n".join(head + lines) + "\n")
    found = indexes.read_filing_index(spark, str(tmp_path)).orderBy(F.desc("year"), F.desc("quarter"), "position").collect()
    assert [(r["form_type"], r["company"], r["cik"], r["accession"]) for r in found] == [
        ("10-K", "B Co", "1", "0000000001-23-000001"),
        ("8-K", "D Co", "7", "z"),
        ("S-1", "E Co", "1", "0000000001-23-000001"),
    ]


def test_submissions(spark):
    bodies = [
        ("1", '{"sic": "1000", "sicDescription": "Mining", "filings": {"recent": {"accessionNumber": ["a", "b"], "filingDate": ["2023-01-01"]}}}'),
        ("2", '{"filings": {}}'),
        ("3", '{"sic": "", "filings": {"recent": {"accessionNumber": ["c"]}}}'),
        ("4", "<html>503</html>"),
        ("5", None),
        ("6", '{"sic": "10'),
    ]
    bodies = spark.createDataFrame(bodies, "cik string, body string")
    assert sorted(r["cik"] for r in indexes.malformed_submissions(bodies).collect()) == ["4", "5", "6"]
    parsed = indexes.parse_submissions(bodies)
    assert [tuple(r) for r in indexes.companies_from(parsed).orderBy("cik").collect()] == [("1", "1000", "Mining"), ("2", None, None), ("3", "", None)]
    assert [tuple(r) for r in indexes.filing_dates_from(parsed).collect()] == [("1", "a", "2023-01-01")]


def test_listing_without_a_table(spark):
    pages = spark.createDataFrame([("1", "a-1", "<html>nothing</html>"), ("1", "a-2", None)], "cik string, accession string, html string")
    assert indexes.list_exhibits(pages).count() == 0
    assert [r["accession"] for r in indexes.unreadable_pages(pages).collect()] == ["a-2"]


def test_stream_resumes(spark, raw, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        append_clauses(stream_exhibits(spark, raw), out, checkpoint).awaitTermination(120)
        return sorted((r["filename"], r["label"]) for r in spark.read.parquet(out).collect())

    first = run()
    assert first == [("a b%20c.htm", "Termination"), ("unfinished.htm", "Termination"), ("y.htm", "Governing Law"), ("y.htm", "Payment Terms")]
    assert run() == first
    from pathlib import Path

    _write(Path(raw), "4", "0000000004-23-000001", "new.htm", b"Assignment", BODY)
    assert run() == sorted([*first, ("new.htm", "Assignment")])
    _write(Path(raw), "5", "0000000005-20-000001", "old.htm", b"Assignment", BODY)
    month_ago = time.time() - 30 * 86400
    os.utime(Path(raw) / "5" / "0000000005-20-000001" / "old.htm", (month_ago, month_ago))
    assert ("old.htm", "Assignment") in run()


# --- shape of the plans ------------------------------------------------------------------------


def _plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_extraction_does_not_shuffle(spark, raw):
    plan = _plan(extract(exhibits.read_exhibits(spark, raw)))
    assert "Exchange" not in plan and "Window" not in plan
    assert plan.count("ArrowEvalPython") == 1
    failed = _plan(extract(exhibits.read_exhibits(spark, raw)).where(F.col("error").isNotNull()))
    assert failed.count("ArrowEvalPython") == 1
    assert _plan(with_lines(exhibits.read_exhibits(spark, raw))).count("ArrowEvalPython") == 1


def test_choices_are_made_on_narrow_rows(spark, folder, tmp_path):
    from clausemill.operators.curate import sample_pool
    from clausemill.functions.taxonomy import CONTRACTS
    from clausemill.operators import profile as A

    path = str(tmp_path / "store")
    tables.write_table(star.store(spark, folder), path)
    store = tables.read_store(spark, path)
    pool = _plan(sample_pool(store, 100, 10, 42, CONTRACTS))
    assert pool.count("WindowGroupLimit") >= 2
    assert "text" not in pool.split("ReadSchema:")[1]
    lengths = _plan(A.length_summary(A.length_counts(store)))
    assert "ReadSchema: struct<label:string,text_len:int>" in lengths


def _star(spark, folder):
    """Three orders, one of them twice; two items of one order have one id."""
    rows = {
        "nation": ([(1, "CANADA")], "n_nationkey long, n_name string"),
        "customer": ([(1, "A", 1, 5.0, "MACHINERY"), (2, "B", 1, -5.0, "BUILDING")], "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string"),
        "orders": (
            [(o, c, "F", datetime.datetime(1996, 1, 2), f"{p}-X") for o, c, p in [(7, 1, 1), (7, 1, 1), (8, 2, 4), (9, 1, 5)]],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (
            [(o, n, p, datetime.datetime(1997, 1, d)) for o, n, p, d in [(7, 1, 10, 1), (7, 6, 20, 2), (7, 2, 11, 3), (8, 1, 10, 4), (9, 1, 12, 5), (9, 2, 13, 6)]],
            "l_orderkey long, l_linenumber long, l_partkey long, l_shipdate timestamp",
        ),
        "documents": ([(0, "zero"), (1, "one one"), (2, None)], "doc_id long, text string"),
    }
    for name, (values, kind) in rows.items():
        spark.createDataFrame(values, kind).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_a_store_without_texts_is_not_shuffled_by_id(spark, tmp_path):
    folder = _star(spark, tmp_path)
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("w6_longest_per_label", "p5_label_industry_year"):
            assert "hashpartitioning(clause_id" not in QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        found = star.with_texts(spark, folder, star.store_narrow(spark, folder)).select(*ENRICHED_COLUMNS).collect()
        expected = star.store(spark, folder).select(*ENRICHED_COLUMNS).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert {row.text for row in expected} == {"zero", "one one"}
    assert sorted(map(str, found)) == sorted(map(str, expected))
