"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8) the local
cores. Every query runs into the no-op sink: once to warm up, then BENCH_RUNS (default 3) times;
the median counts. BENCH_QUERIES, comma-separated, picks other queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claimscope.plans.catalog import QUERIES  # noqa: E402
from claimscope.session import get_session  # noqa: E402

HEADLINE = [
    "clean_fill_median", "clean_title_case", "transform_claims", "scan_table", "stg_claims",
    "agg_by_severity", "agg_top_makes", "agg_fraud_vs_legit", "mart_fraud_summary", "hist_claim_amount", "page_claims",
    "dq_report", "dq_suite_run", "contract_validate", "dq_profile",
    "feature_row", "encode_labels", "fs_upsert", "lookup_batch_features", "lineage_downstream", "skip_processed",
    "eval_auc", "eval_class_report", "split_stratified",
    "profile_numeric", "drift_psi", "drift_ks", "drift_chi2", "drift_overall",
    "health_report", "metric_histogram", "runlog_retain",
    "sink_table_replace", "incremental_load", "stream_ingest", "health_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k] or HEADLINE
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for key in keys:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[key] = round(statistics.median(times[1:] or times), 3)
        print(f"{key} {seconds[key]} {[round(t, 2) for t in times]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
