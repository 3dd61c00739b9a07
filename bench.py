"""Headline timings on local[$BENCH_CPUS] over $BENCH_SF_DIR, as one JSON line.

The inputs of each step (rendered exhibits, the clause corpus, the store) are written first, as they
would be in production, so each time is that of the step alone.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from clausemill.catalog import star  # noqa: E402
from clausemill.operators import curate, extract, profile  # noqa: E402
from clausemill.plans.corpus import build_corpus  # noqa: E402
from clausemill.plans.dataset import SetSizes  # noqa: E402
from clausemill.plans.store import build_store  # noqa: E402
from clausemill.session import local_session, scratch_path  # noqa: E402
from clausemill.sources import tables  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, memory="16g", shuffle_partitions=cores)
    sizes = SetSizes()
    seconds: dict[str, float] = {}

    def timed(name, run):
        started = time.perf_counter()
        result = run()
        seconds[name] = round(time.perf_counter() - started, 3)
        return result

    def drain(rows):
        return lambda: rows.write.format("noop").mode("overwrite").save()

    def stored(name, rows):
        path = scratch_path(spark, f"bench-{name}")
        tables.write_table(rows, path)
        return spark.read.parquet(path)

    documents = stored("exhibits", star.exhibits(spark, folder).drop("doc_id"))
    manifest = stored("manifest", star.manifest(spark, folder))
    corpus = stored("corpus", star.clauses(spark, folder))
    companies = stored("companies", star.companies(spark, folder))
    dates = stored("dates", star.filing_dates(spark, folder))
    megabytes = documents.selectExpr("sum(octet_length(raw)) / 1e6").first()[0]
    drain(extract.with_lines(documents.limit(100 * cores).repartition(cores)))()  # starts the Python workers

    timed("raw_to_lines", drain(extract.with_lines(documents)))
    timed("raw_to_clauses", drain(extract.extract(documents)))
    timed("corpus_job", lambda: build_corpus(spark, documents, manifest, scratch_path(spark, "bench-job")))
    store_path = scratch_path(spark, "bench-store")
    loaded = timed(
        "enrich_and_load", lambda: build_store(corpus, companies, dates, store_path, load_order=star.LOAD_ORDER)
    )
    store = tables.read_store(spark, store_path)
    timed("company_split", drain(curate.assign_buckets(store)))
    timed(
        "train_sample",
        drain(curate.stratified_sample(curate.of_bucket(store, "train"), sizes.train_per_category, sizes.train_company_cap)),
    )
    timed(
        "val_sample",
        drain(curate.stratified_sample(curate.of_bucket(store, "val"), sizes.val_per_category, sizes.val_company_cap)),
    )
    timed("evaluation_candidates", drain(curate.evaluation_candidates(curate.of_bucket(store, "test"), sizes.eval_per_category)))
    lengths = profile.length_counts(store)
    timed("length_summary", drain(profile.length_summary(lengths)))
    timed("length_boxes", drain(profile.length_boxes(lengths)))
    timed("label_by_form", drain(profile.label_by_form(store)))
    timed("coverage", drain(profile.coverage(store)))
    timed("top_industries", drain(profile.top_industries(store)))
    timed("null_counts", drain(profile.null_counts(store)))
    timed("duplicate_rows", drain(profile.duplicate_rows(store)))
    timed("concentration", drain(profile.concentration(profile.company_sizes(store))))
    timed("companies_for_half", drain(profile.companies_for_half(profile.company_sizes(store))))

    count = documents.count()
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cores": cores,
                "documents": count,
                "documents_per_second": round(count / seconds["raw_to_clauses"], 1),
                "raw_megabytes_per_second": round(megabytes / seconds["raw_to_clauses"], 2),
                "clauses_loaded_per_second": round(loaded.rows / seconds["enrich_and_load"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
