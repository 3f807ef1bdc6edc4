"""Physical plans: no nested-loop or Cartesian join, no Python in row-level work, pruned and filtered scans."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from claimscope.plans.catalog import QUERIES

KEYS = [
    "transform_claims", "stg_claims", "claims_browser", "agg_by_severity", "agg_top_makes", "mart_fraud_summary", "hist_claim_amount",
    "dq_report", "dq_profile", "contract_validate", "feature_row", "encode_labels", "fs_upsert", "lookup_batch_features",
    "lineage_downstream", "skip_processed", "eval_auc", "model_metrics", "split_stratified", "drift_psi", "drift_ks", "drift_chi2",
    "drift_overall", "drift_report", "health_report", "metric_histogram", "runlog_retain",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_bad_joins_and_no_python(spark, sf_dir, key):
    text = plan(QUERIES[key](spark, sf_dir))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups", text), text


def test_scan_reads_only_what_it_needs(spark, sf_dir):
    text = plan(QUERIES["agg_by_severity"](spark, sf_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas == ["incident_severity:string,is_fraud:int"]
    assert "EqualTo(is_fraud,1)" in plan(QUERIES["filter_fraud_only"](spark, sf_dir))


def test_retention_limits_each_task_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["runlog_retain"](spark, sf_dir))
    exchange = text.index("Exchange hashpartitioning(status")
    assert "WindowGroupLimit" in text[exchange:], "a partial limit below the exchange"


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["agg_top_makes"](spark, sf_dir))


def test_last_write_wins_without_sorting_rows(spark, sf_dir):
    text = plan(QUERIES["fs_upsert"](spark, sf_dir))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_plans_of_eager_steps_are_seen(spark, tmp_path, plans_since):
    spark.range(3).select(F.udf(str)("id").alias("x")).write.parquet(str(tmp_path / "out"))
    spark.range(1).collect()
    seen = plans_since()
    assert any("EvalPython" in p for p in seen) and "EvalPython" not in seen[-1]
    assert plans_since() == []
