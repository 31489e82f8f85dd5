"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import glob
import json
import os
import sys
import time

from furrow.plans.queries import all_queries
from furrow.session import build_session, run_folder

HEADLINE = (
    "lexicon_topic_counts", "lexicon_match_pairs", "lexicon_match_by_join", "tidy_text", "dominant_script",
    "repair_gate_scores", "line_ordinals", "section_forward_fill", "line_facets", "segment_passages", "passages",
    "extraction_report", "resource_rollup", "corpus_resources", "facet_index", "discover_topk",
    "validation_violations", "claims_hash", "ledger_changes", "upsert_latest_wins", "cosine_topk",
    "discovery_scoped_search", "vector_points", "gap_candidates", "gap_across_documents",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    registered, took = all_queries(), {}
    names = sys.argv[1:] or HEADLINE
    # Start the engine and touch the tables: scans, an exchange and Python workers, but no query.
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        rows = spark.read.parquet(path)
        rows.repartition(int(cpus)).mapInArrow(lambda batches: batches, rows.schema).write.format("noop").mode("overwrite").save()
    for name in names:
        with run_folder(spark):
            started = time.perf_counter()
            registered[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
