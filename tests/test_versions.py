"""The store as a row of versions: pruned reads, small loads, failed loads."""

import pytest
from pyspark.sql import functions as F

from clausemill.catalog import star
from clausemill.functions.ids import split_bucket
from clausemill.operators import checks, curate, extract
from clausemill.operators.enrich import ENRICHED_COLUMNS
from clausemill.operators import profile as A
from clausemill.plans import profile
from clausemill.plans.dataset import curated_sets
from clausemill.plans.store import build_store
from clausemill.session import scratch_path
from clausemill.sources import schemas, store


@pytest.fixture(scope="module")
def loaded(spark, folder):
    path = scratch_path(spark, "versions")
    build_store(star.clauses(spark, folder), star.companies(spark, folder), star.filing_dates(spark, folder), path, load_order=star.LOAD_ORDER)
    return path


def _plan(rows):
    return rows._jdf.queryExecution().explainString(rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def _metric(rows, name):
    """A metric of the one scan of a plan, after it was run."""
    rows.write.format("noop").mode("overwrite").save()
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan()
    leaves = plan.finalPhysicalPlan().collectLeaves() if "Adaptive" in plan.nodeName() else plan.collectLeaves()
    return leaves.apply(0).metrics().get(name).get().value()


def test_a_label_reads_its_own_folders(spark, loaded):
    everything, found = store.read_store(spark, loaded), checks.filtered_clauses(store.read_store(spark, loaded), "Indemnification", "1998-01-01", "1999-01-01")
    plan = _plan(found)
    assert "PartitionFilters" in plan and "topic" in plan.split("PartitionFilters")[1].splitlines()[0]
    assert found.count() > 0
    assert _metric(found, "filesSize") < 0.2 * _metric(everything, "filesSize")


def test_a_bucket_reads_its_own_parts(spark, loaded):
    whole = store.read_store(spark, loaded)
    for bucket in ("train", "val", "test"):
        members = store.read_store(spark, loaded, bucket)
        expected = whole.where(split_bucket(F.col("cik")) == bucket)
        assert sorted(members.select("clause_id").collect()) == sorted(expected.select("clause_id").collect())
        assert "part" in _plan(members).split("PartitionFilters")[1].splitlines()[0]


def test_chosen_rows_are_looked_up_by_their_keys(spark, loaded):
    whole = store.read_store(spark, loaded)
    chosen = whole.orderBy("clause_id").limit(30).select("clause_id", "accession")
    place = scratch_path(spark, "chosen")
    chosen.write.parquet(place)
    chosen = spark.read.schema("clause_id string, accession string").parquet(place)
    found = curate.rows_of(whole, chosen)
    plan = _plan(found)
    assert "In(clause_id" in plan and "In(accession" in plan
    assert sorted(r["clause_id"] for r in found.collect()) == sorted(r["clause_id"] for r in chosen.collect())
    assert curate.rows_of(whole, chosen.where("false")).count() == 0
    before = curate.PUSHED_KEYS
    curate.PUSHED_KEYS = 3
    try:
        joined = curate.rows_of(whole, chosen)
        assert "In(clause_id" not in _plan(joined)
        assert sorted(map(str, joined.collect())) == sorted(map(str, found.collect()))
    finally:
        curate.PUSHED_KEYS = before


def _rows(spark, *rows):
    """Clauses of (id, label, cik, accession, text)."""
    made = [(i, label, "H", text, cik, None, None, None, accession, "f", None, None, None, None, len(text)) for i, label, cik, accession, text in rows]
    return spark.createDataFrame(made, schemas.ENRICHED)


def _texts(spark, path, version=None):
    return {r["clause_id"]: (r["label"], r["text"]) for r in store.read_store(spark, path, version=version).collect()}


def test_a_load_writes_what_changes_and_older_versions_stay(spark):
    path = scratch_path(spark, "store")
    first = _rows(spark, *[(f"i{k}", f"L{k % 3}", f"c{k}", f"a{k}", f"t{k}") for k in range(60)], ("e", "", "c1", "it's a \\ key", "empty label"))
    assert store.commit_load(first, path) == 1
    assert store.commit_load(_rows(spark, ("i7", "L1", "c7", "a7", "new"), ("n", "L0", "c7", "a99", "added")), path) == 2
    now, before = _texts(spark, path), _texts(spark, path, 1)
    assert now["i7"] == ("L1", "new") and now["n"] == ("L0", "added") and now["e"] == ("", "empty label") and len(now) == 62
    assert before["i7"] == ("L1", "t7") and len(before) == 61
    old, new = (set(store.version_files(spark, path, n)) for n in (1, 2))
    assert len(old - new) == 1
    whole = store.read_store(spark, path)
    keys = whole.where("clause_id = 'e'").select("clause_id", "accession")
    assert [r["text"] for r in curate.rows_of(whole, keys).collect()] == ["empty label"]
    store.remove_old_versions(spark, path)
    assert _texts(spark, path) == now and store.latest_version(spark, path) == 2
    assert store.commit_load(_rows(spark, ("x", "L0", "c", "a", "t")), path, recreate=True) == 3
    assert set(_texts(spark, path)) == {"x"}
    assert store.commit_load(_rows(spark), path) == 4 and set(_texts(spark, path)) == {"x"}


def test_files_of_replaced_rows_alone_are_not_written_again(spark):
    path = scratch_path(spark, "store")
    rows = _rows(spark, *[(f"i{k}", f"a: {k % 2} %", f"c{k % 4}", f"a{k}", f"t{k}") for k in range(20)])
    store.commit_load(rows, path)
    store.commit_load(rows.withColumn("text", F.lit("new")), path)
    assert len(_texts(spark, path)) == 20 and {text for _, text in _texts(spark, path).values()} == {"new"}
    assert not any("-kept" in name for name in store.version_files(spark, path, 2))
    place, system = store._hadoop(spark, f"{path}/data/*-kept")
    assert not system.globStatus(place)


def test_a_load_without_texts_equals_one_with_them(spark):
    texts = spark.createDataFrame([(1, "one"), (2, "two"), (3, None), (4, "four"), (5, "five")], "place int, text string")
    made = [("A", "h", "1", "x", 5, 1), ("A", "h", "1", "x", 7, 2), ("A", "h", "1", "y", 1, 5), ("B", "h", "2", "x", 1, 3), (None, "h", "2", "x", 1, 4), ("B", "i", None, "x", 1, 4)]
    rows = spark.createDataFrame(made + made[:2], "label string, section_header string, cik string, accession string, at int, place int")
    nothing = {name: F.lit(None).cast("string") for name in ("company", "form_type", "file_type", "filing_year")}
    whole = rows.join(texts, "place").withColumns({"filename": F.lit("f"), **nothing})
    there = {"text_len": F.length("text"), "text_hash": F.xxhash64("text"), "text": F.when(F.col("text").isNotNull(), F.lit(""))}
    companies = spark.createDataFrame([("1", "10", "Mining")], "cik string, sic string, sic_description string")
    dates = spark.createDataFrame([("1", "x", "1998-01-02")], "cik string, accession string, filing_date string")
    found = []
    for corpus, fetch in ((whole.drop("place"), None), (whole.withColumns(there), lambda kept: kept.drop("text").join(texts, "place"))):
        path, refused = scratch_path(spark, "store"), scratch_path(spark, "refused")
        counts = build_store(corpus, companies, dates, path, refused, ("at",), texts=fetch, within=("accession",))
        assert (counts.rows, counts.refused) == (8, 3)
        read = [store.read_store(spark, path), spark.read.schema(schemas.ENRICHED).parquet(refused)]
        found.append([sorted(map(str, kept.select(*ENRICHED_COLUMNS).collect())) for kept in read])
    assert found[0] == found[1] and [len(kept) for kept in found[0]] == [2, 3]
    assert "text='two'" in "".join(found[0][0]) and "text='four'" in "".join(found[0][1])


def test_computed_keys_meet_one_list(spark):
    rows = _rows(spark, *[(f"i{k}", "L", "c", f"a{k}", "t") for k in range(300)]).withColumn("clause_id", F.sha1("clause_id"))
    place = scratch_path(spark, "chosen")
    rows.select("clause_id", "accession").limit(200).write.parquet(place)
    chosen = spark.read.schema("clause_id string, accession string").parquet(place)
    found = curate.rows_of(rows, chosen, computed=True)
    lists = found._jdf.queryExecution().optimizedPlan().toString()
    assert lists.count("sha1(") <= 3 and found.count() == 200


def test_sets_of_a_store_without_texts_have_their_texts(spark):
    rows = _rows(spark, *[(f"i{k}", "Indemnification", f"c{k}", f"a{k}", f"t{k}") for k in range(200)])
    texts = rows.select("clause_id", "text")
    whole, narrow = curated_sets(rows), curated_sets(rows.drop("text"), texts=lambda chosen: chosen.join(texts, "clause_id"))
    for name in ("train", "val", "eval_candidates"):
        assert whole[name].count() > 0 and whole[name].collect() == narrow[name].collect()


def test_a_failed_load_leaves_the_store(spark):
    path = scratch_path(spark, "store")
    store.commit_load(_rows(spark, ("a", "L", "c", "x", "old")), path)
    broken = _rows(spark, ("a", "L", "c", "x", "new")).withColumn("text", F.when(F.col("cik") == "c", F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        store.commit_load(broken, path)
    assert _texts(spark, path) == {"a": ("L", "old")}
    # The last write, that of the version, fails half way: no mark of success.
    spark.createDataFrame([("load=gone/part=0/topic=L/x.parquet",)], "file string").write.parquet(f"{path}/versions/0000000002")
    place, system = store._hadoop(spark, f"{path}/versions/0000000002/_SUCCESS")
    system.delete(place, False)
    assert _texts(spark, path) == {"a": ("L", "old")}
    assert store.commit_load(_rows(spark, ("b", "L", "c", "x", "later")), path) == 3
    assert _texts(spark, path) == {"a": ("L", "old"), "b": ("L", "later")}


def test_a_plain_table_becomes_a_store(spark):
    path = scratch_path(spark, "store")
    _rows(spark, ("a", "L", "c", "x", "old"), ("b", "L", "c", "x", "kept")).write.parquet(path)
    assert store.read_store(spark, path).count() == 2
    store.commit_load(_rows(spark, ("a", "L", "c", "x", "new")), path)
    assert _texts(spark, path) == {"a": ("L", "new"), "b": ("L", "kept")}


def test_contents_are_compared(spark):
    rows = _rows(spark, ("a", "L", "c", "x", "one"), ("b", "L", "c", "x", "two"), ("b", "L", "c", "x", "two"))
    other = _rows(spark, ("b", "L", "c", "x", "two"), ("a", "L", "c", "x", "one"), ("b", "L", "c", "x", "two"))
    moved = _rows(spark, ("a", "L", "c", "x", "two"), ("b", "L", "c", "x", "one"), ("b", "L", "c", "x", "two"))
    assert checks.reconcile_contents(rows, other, ENRICHED_COLUMNS).first()["agree"]
    assert not checks.reconcile_contents(rows, moved, ENRICHED_COLUMNS).first()["agree"]
    nothing = checks.reconcile_contents(_rows(spark), _rows(spark), ENRICHED_COLUMNS).first()
    assert nothing["agree"] and nothing["source_digest"] == "0"


def test_a_document_over_the_budget_is_one_failed_row(spark):
    rows = [("big", "<p>" + "x" * 5000 + "</p>"), ("deep", "<div>" * 100_000 + "text" + "</div>" * 100_000), ("small", "<p>a</p>"), ("none", None)]
    found = extract.with_lines(spark.createDataFrame(rows, "name string, raw string"), max_bytes=1_200_000).collect()
    found = {r["name"]: r for r in found}
    assert found["deep"]["lines"] == ["text"] and found["small"]["lines"] == ["a"] and found["none"]["error"]
    again = extract.with_lines(spark.createDataFrame(rows, "name string, raw string"), max_bytes=4000).collect()
    errors = {r["name"]: r["error"] for r in again}
    assert errors["big"].startswith("TooLarge: 5007") and errors["small"] is None


def _tables(spark, paths):
    return {name: sorted(map(str, spark.read.parquet(place).collect())) for name, place in paths.items()}


def test_a_profile_after_a_load_reads_the_new_files(spark):
    path = scratch_path(spark, "store")
    rows = [(f"i{k}", f"L{k % 3}", f"c{k % 7}", f"a{k % 9}", f"t{k}" * (k % 5)) for k in range(60)]
    first = _rows(spark, *rows, ("e", "", None, "it's a key", "empty label"), ("s", "a b/c%20", "c1", None, "odd label")).withColumn("company", F.col("cik"))
    store.commit_load(first, path)
    everything = set(store.version_files(spark, path, 1))
    assert set(profile.count_new_files(spark, path)) == everything and profile.count_new_files(spark, path) == []
    changed = _rows(spark, ("i7", "L1", "c0", "a7", "new"), ("n", "L0", "c6", "a99", "added")).withColumn("sic", F.lit("0000"))
    store.commit_load(changed, path)
    new = set(profile.count_new_files(spark, path))
    assert new and new == set(store.version_files(spark, path, 2)) - everything and len(new) < len(everything)
    # A set whose list of files is missing was not finished, and does not count.
    spark.range(1).write.parquet(f"{path}/profile/0000000009-broken/lengths")
    kept = _tables(spark, profile.profile_store(spark, path, scratch_path(spark, "profile")))
    whole = _tables(spark, profile.build_profile(spark, store.read_store(spark, path), scratch_path(spark, "profile")))
    assert kept == whole
    assert whole["coverage"] and "rows=63" in whole["coverage"][0] and len(whole["examples"]) == 5


def test_counts_agree_with_the_operators(spark, loaded):
    whole = store.read_store(spark, loaded)
    made = profile.build_profile(spark, whole, scratch_path(spark, "profile"))
    expected = {
        "null_counts": A.null_counts(whole),
        "duplicate_rows": A.duplicate_rows(whole),
        "duplicate_keys": A.duplicate_keys(whole, profile.KEY),
        "distinct_counts": A.distinct_counts(whole, ["accession", "cik"]),
        "label_shares": A.label_shares(whole),
        "label_frequencies": A.label_frequencies(whole),
        "imbalance": A.imbalance(whole),
        "form_types": A.count_by(whole, "form_type"),
        "filing_years": A.count_by(whole, "filing_year"),
        "label_by_form": A.label_by_form(whole),
        "coverage": A.coverage(whole),
        "companies_without_industry": A.companies_without_industry(whole),
        "top_industries": A.top_industries(whole),
        "top_industry_share": A.top_industry_share(whole),
        "examples": curate.one_per_label(whole),
    }
    tables = _tables(spark, {name: made[name] for name in expected})
    assert tables == {name: sorted(map(str, rows.collect())) for name, rows in expected.items()}


def test_a_profile_of_an_empty_store(spark):
    path = scratch_path(spark, "store")
    store.commit_load(_rows(spark), path)
    kept = _tables(spark, profile.profile_store(spark, path, scratch_path(spark, "profile")))
    assert kept["company_sizes"] == [] and "rows=0" in kept["coverage"][0]


def test_many_chosen_keys_do_not_exhaust_the_stack(spark, tmp_path):
    rows = spark.range(20_000).select(F.sha1(F.col("id").cast("string")).alias("clause_id"), F.concat(F.lit("a'"), "id").alias("accession"), "id")
    rows.write.parquet(f"{tmp_path}/rows")
    stored = spark.read.schema(rows.schema).parquet(f"{tmp_path}/rows")
    stored.where("id % 4 = 0").select("clause_id", "accession").limit(curate.PUSHED_KEYS).write.parquet(f"{tmp_path}/chosen")
    chosen = spark.read.parquet(f"{tmp_path}/chosen")
    found = curate.rows_of(stored, chosen)
    assert sorted(r["clause_id"] for r in found.collect()) == sorted(r["clause_id"] for r in chosen.collect())


def test_one_list_of_computed_keys_does_not_exhaust_the_stack(spark, tmp_path):
    # The join hands the list to the scan of the chosen keys.
    rows = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("clause_id"), F.col("id").alias("n")).withColumn("clause_id", F.sha1("clause_id"))
    rows.where(F.col("n") < curate.PUSHED_KEYS).select("clause_id").write.parquet(f"{tmp_path}/computed")
    found = curate.rows_of(rows, spark.read.parquet(f"{tmp_path}/computed"), computed=True)
    assert sorted(r["n"] for r in found.collect()) == list(range(curate.PUSHED_KEYS))
