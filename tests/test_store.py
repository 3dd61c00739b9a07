import datetime
import hashlib
import re

from pyspark.sql import functions as F

from clausemill.catalog import profiling, star  # noqa: F401  (the first registers its queries)
from clausemill.catalog.registry import QUERIES
from clausemill.functions.ids import clause_id
from clausemill.operators import profile as A
from clausemill.operators import upsert as K
from clausemill.operators.enrich import ENRICHED_COLUMNS, enrich, first_per_key, with_filing_date, with_id_and_length
from clausemill.operators.topk import first_k
from clausemill.operators.worklist import next_documents, not_yet_done, quarters_backward, unknown_companies
from clausemill.plans import store as plans_store
from clausemill.sources import schemas
from clausemill.sources.tables import write_table


def _day(n):
    return datetime.datetime(2024, 1, n)


def test_manifest_upsert_refreshes_only_status_and_time(spark):
    old = [("a", "1", "c", "First", "8-K", "EX-10", "failed", _day(1)), ("b", "1", "c", "Kept", None, None, "failed", _day(2))]
    new = [("a", "1", "c", "Second", "10-K", "EX-99", "", _day(3)), ("d", "1", "c", "New", None, None, "", _day(4)), ("d", "1", "c", "Newer", "x", None, "", _day(5))]
    merged = K.upsert_manifest(spark.createDataFrame(old, schemas.MANIFEST), spark.createDataFrame(new, schemas.MANIFEST))
    assert sorted(tuple(r) for r in merged.collect()) == [
        ("a", "1", "c", "First", "8-K", "EX-10", "done", _day(3)),
        ("b", "1", "c", "Kept", None, None, "failed", _day(2)),
        ("d", "1", "c", "New", None, None, "done", _day(5)),
    ]


def test_dimension_upsert_replaces_whole_rows(spark):
    old = spark.createDataFrame([("1", "10", "Ten", 0), ("2", "20", "Twenty", 0)], schemas.COMPANIES + ", seq int")
    new = spark.createDataFrame([("1", None, None, 1), ("3", "30", "x", 1), ("3", "31", "y", 2)], schemas.COMPANIES + ", seq int")
    got = K.upsert_rows(old, new, ["cik"], [F.desc("seq")]).drop("seq")
    assert sorted((tuple(r) for r in got.collect()), key=str) == [("1", None, None), ("2", "20", "Twenty"), ("3", "31", "y")]


CORPUS = [
    ("Termination", "T", "x" * 40, "1", "A", "8-K", "EX-10", "a-23-1", "f", "2023"),
    ("Termination", "T", "y" * 50, "1", "A", "8-K", "EX-10", "a-23-1", "f", "2023"),
    ("Payment Terms", "P", "z" * 45, "2", None, None, None, "a-23-2", "f", None),
]


def test_enrich_and_load(spark):
    corpus = spark.createDataFrame([(*row, n) for n, row in enumerate(CORPUS)], schemas.CLAUSES + ", seq int")
    companies = spark.createDataFrame([("1", "", None)], schemas.COMPANIES)
    dates = spark.createDataFrame([("1", "a-23-1", "2023-02-03"), ("2", "a-23-2", "2023-13-01")], "cik string, accession string, filing_date string")
    rows = enrich(corpus, companies, dates, ("seq",))
    assert rows.columns == [*ENRICHED_COLUMNS, "seq"]
    assert sorted((r["seq"], r["filing_date"], r["sic"], r["text_len"]) for r in rows.collect()) == [
        (0, datetime.date(2023, 2, 3), "", 40),
        (1, datetime.date(2023, 2, 3), "", 50),
        (2, None, None, 45),
    ]
    loaded = K.load(rows, [F.desc("seq")])
    assert sorted(r["seq"] for r in loaded.collect()) == [1, 2]
    assert sorted(r["seq"] for r in K.load(loaded.unionByName(rows), [F.desc("seq")]).collect()) == [1, 2]
    assert K.rejected(rows.withColumn("label", F.when(F.col("seq") > 0, F.col("label")))).count() == 1
    assert corpus.select(clause_id()).distinct().count() == 2


def test_dimensions_with_repeated_keys_do_not_multiply_clauses(spark):
    companies = spark.createDataFrame([("1", "10", "a"), ("1", "20", "b"), ("2", None, None)], schemas.COMPANIES)
    assert sorted(tuple(r) for r in first_per_key(companies, "cik").collect()) == [("1", "20", "b"), ("2", None, None)]


def test_forms_of_a_label_add_up(spark):
    rows = [("L", "10-K"), ("L", "10-K/A"), ("M", "10-KT"), ("M", None)]
    found = A.label_by_form(spark.createDataFrame(rows, "label string, form_type string")).collect()
    assert sorted((r["label"], r["form_type"], r["share"]) for r in found) == [("L", "10-K", 0.5), ("L", "10-K/A", 0.5), ("M", "10-KT", 1.0)]


def test_large_dimensions_give_the_same_rows(spark):
    corpus = spark.createDataFrame(CORPUS, schemas.CLAUSES)
    dates = spark.createDataFrame([("1", "a-23-1", "2023-02-03")], "cik string, accession string, filing_date string")
    small = sorted(map(str, with_filing_date(corpus, dates).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, with_filing_date(corpus, dates).collect())) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_work_lists(spark):
    assert [tuple(r) for r in quarters_backward(spark, 2002, 2).collect()] == [(0, 2002, 2), (1, 2002, 1), (2, 2001, 4), (3, 2001, 3), (4, 2001, 2), (5, 2001, 1)]
    assert quarters_backward(spark, 2000, 4).count() == 0
    manifest = spark.createDataFrame([("a", "1", "done"), ("b", "1", "failed")], "accession string, filename string, status string")
    documents = spark.createDataFrame(
        [("a", "1", 2023, 4, 0), ("b", "1", 2023, 3, 5), ("b", "2", 2023, 4, 9), ("c", "1", 2023, 3, 1)],
        "accession string, filename string, year int, quarter int, position int",
    )
    assert not_yet_done(documents, manifest).count() == 3
    got = next_documents(documents, manifest, 2, ["position"]).collect()
    assert [(r["accession"], r["filename"]) for r in got] == [("b", "2"), ("c", "1")]
    clauses = spark.createDataFrame([("1",), ("2",), ("2",)], "cik string")
    assert [r["cik"] for r in unknown_companies(clauses, spark.createDataFrame([("1", None, None)], schemas.COMPANIES)).collect()] == ["2"]


def test_first_k_keeps_hot_groups_whole(spark):
    rows = spark.range(2000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g"), "id")
    top = first_k(rows, ["g"], [F.desc("id")], 7)
    groups = {}
    for r in rows.collect():
        groups.setdefault(r["g"], []).append(r["id"])
    got = {}
    for r in top.collect():
        got.setdefault(r["g"], []).append((r["rank"], r["id"]))
    assert {g: sorted(v) for g, v in got.items()} == {g: list(enumerate(sorted(v, reverse=True)[:7], 1)) for g, v in groups.items()}


def test_concentration_by_hand(spark):
    rows = spark.createDataFrame([(c,) for c in "aaaaabbbccdeff"] + [(None,)], "company string")
    curve = sorted((r["rank"], r["n"], r["running"]) for r in A.concentration(A.company_sizes(rows)).collect())
    assert curve == [(1, 5, 5), (2, 3, 8), (3, 2, 10), (4, 2, 12), (5, 1, 13), (6, 1, 14)]
    half = A.companies_for_half(A.company_sizes(rows)).first()
    assert (half["n_for_half"], half["companies"]) == (2, 6)
    assert A.median_company_size(A.company_sizes(rows)).first()[0] == 2.0


def test_concentration_of_many_companies_of_one_size(spark, monkeypatch):
    sizes = spark.range(200_000).select(F.concat(F.lit("c"), "id").alias("company"), F.lit(1).cast("long").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # they are a megabyte, which would be one range
    try:
        placed = A.ranged_sizes(sizes)
        ranges = [r["count"] for r in placed.groupBy("range").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(ranges) > 4 and max(ranges) < 2 * sum(ranges) / len(ranges)
    monkeypatch.setattr(A, "ranged_sizes", lambda _: placed)
    curve = A.concentration(sizes)
    found = curve.agg(F.count_distinct("rank"), F.min("rank"), F.max("rank"), F.count_if(F.col("rank") != F.col("running")), F.max("running_pct")).first()
    assert tuple(found) == (200_000, 1, 200_000, 0, 100.0)
    ordered = [r["company"] for r in curve.orderBy("rank").limit(500).collect()]
    assert ordered == sorted(ordered, key=lambda c: (hashlib.md5(c.encode()).hexdigest()[:2], c))
    monkeypatch.undo()
    assert A.concentration(sizes.where("false")).count() == 0


def test_profile_of_nothing(spark):
    none = spark.createDataFrame([], schemas.ENRICHED)
    assert A.frequency_gate(A.label_frequencies(none)).first()["verdict"] == "FAIL"
    assert {r["pct"] for r in A.label_frequencies(none).collect()} == {0.0}
    assert A.duplicate_rows(none).first()[0] == 0
    assert A.coverage(none).first()["rows"] == 0
    assert A.length_histogram(A.length_counts(none)).count() == 0


def test_histogram_of_one_length(spark):
    rows = spark.createDataFrame([("a", 40), ("b", 40)], "label string, text_len int")
    assert [tuple(r) for r in A.length_histogram(A.length_counts(rows)).collect()] == [(1, 2)]
    assert A.length_summary(A.length_counts(rows)).first()["std"] == 0.0


def _exchanges(rows, column):
    """The shuffles of a plan without broadcasts that carry a column, and its scans."""
    spark = rows.sparkSession
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    nodes = [n.strip() for n in rows._jdf.queryExecution().explainString(mode).split("\n\n")]
    carried = [n for n in nodes if re.match(r"\(\d+\) Exchange", n) and re.search(rf"\b{column}#\d+", n)]
    return len(carried), sum(bool(re.match(r"\(\d+\) (BatchScan|Scan)", n)) for n in nodes)


def test_clauses_are_computed_once_by_a_load(spark, tmp_path):
    spark.createDataFrame([(*row, n) for n, row in enumerate(CORPUS)], schemas.CLAUSES + ", seq int").write.parquet(f"{tmp_path}/corpus")
    rows = with_id_and_length(spark.read.parquet(f"{tmp_path}/corpus"))
    assert _exchanges(K.load(rows, [F.desc("seq")]), "text") == (1, 1)


def test_texts_of_the_store_are_joined_last(spark, tmp_path):
    day = datetime.datetime(2020, 1, 2)
    tables = {
        "documents": ([(0, "first", "en"), (0, "twice", "en"), (1, None, "en"), (2, "third", "en"), (4, "", "en")], "doc_id long, text string, lang string"),
        "lineitem": ([(7, p, n, day) for p in (0, 1, 2, 3, 5, 14, None) for n in (1, 1, 2)], "l_orderkey long, l_partkey long, l_linenumber int, l_shipdate timestamp"),
        "orders": ([(7, 3, "F", "1-URGENT", day), (7, 4, "P", "5-LOW", day)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"),
        "customer": ([(3, "A", 1, 5.0, "BUILDING"), (4, "B", 1, -5.0, "HOUSEHOLD")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(1, "N")], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    folder = str(tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("k4_keyed_load", "p2_enriched_clauses"):
            # Once from the documents to the rows, and once where only the length is asked for.
            assert _exchanges(QUERIES[name](spark, folder), "text")[0] <= 2
        whole, plain = star.loaded_whole(spark, folder), star.loaded(spark, folder)
        assert whole.columns == [c for c in plain.columns] and sorted(map(str, whole.collect())) == sorted(map(str, plain.collect()))
        kept = [sorted(map(str, rows.drop("text", "text_len").collect())) for rows in (star.store_whole(spark, folder), star.store(spark, folder))]
        assert kept[0] == kept[1] and len(kept[0]) > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_long_columns_of_readers_of_texts_are_made_above_all_shuffles(spark, tmp_path):
    folder, day = str(tmp_path), datetime.datetime(2020, 1, 2)
    documents = spark.createDataFrame([(n, f"text {n}") for n in range(3)], "doc_id long, text string")
    lines = [(7, p, p, day) for p in range(6)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_shipdate timestamp").write.parquet(f"{folder}/lineitem.parquet")
    documents.write.parquet(f"{folder}/documents.parquet")
    orders = spark.createDataFrame([(7, 3, "F", "1-URGENT", day)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp")
    orders.write.parquet(f"{folder}/orders.parquet")
    customers = spark.createDataFrame([(3, "A", 1, 5.0, "BUILDING")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    customers.write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(1, "N")], "n_nationkey int, n_name string").write.parquet(f"{folder}/nation.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("k4_keyed_load", "p2_enriched_clauses"):
            rows = QUERIES[name](spark, folder)
            assert not any(_exchanges(rows, made)[0] for made in ("clause_id", "section_header", "filename")) and rows.count() == 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_load_does_not_shuffle_clauses_for_the_dimensions(spark, monkeypatch):
    loaded = []
    monkeypatch.setattr(plans_store, "commit_load", lambda rows, path, recreate: (loaded.append(rows), rows.count()))
    made = [("Payment", f"h{n}", "", str(n % 2), "A", None, None, f"a{n % 2}", "f", None, 1, n) for n in range(6)]
    columns = "label string, section_header string, text string, cik string, company string, form_type string, file_type string, accession string"
    corpus = spark.createDataFrame(made, columns + ", filename string, filing_year string, text_len int, text_hash long").repartition("accession")
    companies = spark.createDataFrame([("1", "10", "Mining"), ("1", "09", "Mining")], "cik string, sic string, sic_description string")
    dates = spark.createDataFrame([("1", "a1", "1998-01-02"), ("0", "a0", "x")], "cik string, accession string, filing_date string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans_store.build_store(corpus, companies, dates, "unused", texts=lambda rows: rows, within=("accession",))
        assert _exchanges(loaded[0], "section_header")[0] == 1  # the corpus' own
        found = {(r["clause_id"], r["cik"], r["sic"], str(r["filing_date"])) for r in loaded[0].collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(found) == 6 and {f[1:] for f in found} == {("1", "10", "1998-01-02"), ("0", None, "None")}


def test_written_tables_are_packed_closely(spark, tmp_path):
    write_table(spark.range(3), f"{tmp_path}/rows")
    write_table(spark.range(2), f"{tmp_path}/rows")
    names = [f.name for f in (tmp_path / "rows").glob("*.parquet")]
    assert names and all(".zstd." in name for name in names) and spark.read.parquet(f"{tmp_path}/rows").count() == 2


def test_manifest_is_sorted_above_its_shuffle_alone(spark):
    kind = "accession string, filename string, cik string, company string, form_type string, file_type string, status string, downloaded_at timestamp"
    old = [("a", "f", "1", "old", "10-K", "EX", "failed", datetime.datetime(2020, 1, 1)), (None, "f", "2", None, None, None, "failed", None)]
    new = [("a", "f", "1", "new", "8-K", "EX", "failed", datetime.datetime(2021, 1, d)) for d in (1, 2, 2)]
    merged = K.upsert_manifest(spark.createDataFrame(old, kind), spark.createDataFrame(new, kind))
    below = merged._jdf.queryExecution().executedPlan().toString().split("hashpartitioning(accession")
    assert len(below) == 2 and "Aggregate" not in below[1]
    rows = {row.accession: (row.company, row.status, row.downloaded_at) for row in merged.collect()}
    assert rows == {"a": ("old", "done", datetime.datetime(2021, 1, 2)), None: (None, "failed", None)}
