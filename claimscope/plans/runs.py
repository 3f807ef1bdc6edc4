"""Run-log, health and metric queries; ``now`` is fixed so that results repeat."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimscope.operators import runlog
from claimscope.plans.registry import query, rounded
from claimscope.sources.tables import relation

NOW = "2024-01-31 00:00:00"
_RECENT = f"start_time > TIMESTAMP '{NOW}' - INTERVAL 24 HOUR"


def _now():
    return F.expr(f"TIMESTAMP_NTZ '{NOW}'")


def runs(spark, sf_dir):
    return relation(spark, sf_dir, "run_log")


@query("runlog_last_n", """SELECT run_id, start_time, coalesce(rows_loaded, 0) AS value FROM run_log WHERE status = 'success'
  ORDER BY start_time DESC, run_id DESC LIMIT 7""", ["run_log"])
def runlog_last_n(spark, sf_dir):
    return runlog.last_values(runs(spark, sf_dir), "rows_loaded", 7)


@query("runlog_retain", """SELECT run_id, pipeline_name, start_time, status, execution_time_seconds, rows_extracted, rows_transformed, rows_loaded
  FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY start_time DESC, run_id DESC) AS n FROM run_log
        WHERE status IN ('success', 'failed')) WHERE n <= 30""", ["run_log"])
def runlog_retain(spark, sf_dir):
    return runlog.retain(runs(spark, sf_dir))


_SECONDS = f"date_diff('second', last_time, TIMESTAMP '{NOW}')"
_AGE = f"""CASE WHEN last_time IS NULL THEN 'Never' WHEN {_SECONDS} >= 86400 THEN ({_SECONDS} // 86400) || 'd ago'
  WHEN {_SECONDS} > 3600 THEN ({_SECONDS} // 3600) || 'h ago' ELSE ({_SECONDS} // 60) || 'm ago' END"""


@query("runlog_latest", f"""SELECT last_time, last_run_id, processed, {_AGE} AS age FROM (
  SELECT start_time AS last_time, run_id AS last_run_id, (SELECT count(*) FROM run_log WHERE status = 'success') AS processed
  FROM run_log WHERE status = 'success' ORDER BY start_time DESC, run_id DESC LIMIT 1)""", ["run_log"])
def runlog_latest(spark, sf_dir):
    return runlog.latest_run(runs(spark, sf_dir), _now())


_LAST = "SELECT pipeline_name, max(start_time) FILTER (status = 'success') AS last_time FROM run_log GROUP BY pipeline_name"


@query("run_due", f"SELECT pipeline_name, last_time, CASE WHEN last_time IS NULL OR {_SECONDS} >= 21600 THEN 1 ELSE 0 END AS due FROM ({_LAST})",
       ["run_log"])
def run_due(spark, sf_dir):
    return runlog.due(runs(spark, sf_dir), _now())


@query("run_age_text", f"SELECT pipeline_name, last_time, {_AGE} AS age FROM ({_LAST})", ["run_log"])
def run_age_text(spark, sf_dir):
    last = runlog.last_success(runs(spark, sf_dir), ["pipeline_name"])
    return last.select("pipeline_name", "last_time", runlog.age_text(F.col("last_time"), _now()).alias("age"))


@query("health_window", f"SELECT count(*) AS runs FROM run_log WHERE {_RECENT}", ["run_log"])
def health_window(spark, sf_dir):
    return runlog.recent(runs(spark, sf_dir), _now()).agg(F.count("*").alias("runs"))


_RATE = "coalesce(avg(CASE WHEN status = 'success' THEN 1.0 ELSE 0.0 END), 1.0)"


@query("health_success_rate", f"SELECT {rounded(_RATE, 6)} AS success_rate FROM run_log WHERE {_RECENT}", ["run_log"])
def health_success_rate(spark, sf_dir):
    return runlog.recent(runs(spark, sf_dir), _now()).agg(F.round(runlog.success_rate(), 6).alias("success_rate"))


@query("health_avg_time", f"SELECT {rounded('coalesce(avg(execution_time_seconds), 0)', 4)} AS avg_execution_time FROM run_log WHERE {_RECENT}",
       ["run_log"])
def health_avg_time(spark, sf_dir):
    return runlog.recent(runs(spark, sf_dir), _now()).agg(F.round(runlog.mean_seconds(), 4).alias("avg_execution_time"))


@query("health_report", f"""SELECT {rounded(_RATE + ' * 100', 1)} AS success_rate,
  {rounded('coalesce(avg(execution_time_seconds), 0)', 1)} AS avg_execution_time, count(*) AS total_runs,
  CASE WHEN {_RATE} >= 0.9 THEN 'healthy' ELSE 'degraded' END AS health FROM run_log WHERE {_RECENT}""", ["run_log"])
def health_report(spark, sf_dir):
    return runlog.health_report(runs(spark, sf_dir), _now())


@query("metric_counters", """SELECT pipeline_name, status, count(*) AS runs_total, CAST(sum(rows_extracted) AS BIGINT) AS rows_extracted_total,
  CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded_total FROM run_log GROUP BY pipeline_name, status""", ["run_log"])
def metric_counters(spark, sf_dir):
    return runlog.counters(runs(spark, sf_dir), ["pipeline_name", "status"], ["rows_extracted", "rows_loaded"])


_BUCKETS = [*[(str(b), f"execution_time_seconds <= {b}") for b in runlog.DURATION_BUCKETS], ("+Inf", "TRUE")]


@query("metric_histogram", " UNION ALL ".join(
    f"""SELECT pipeline_name, '{le}' AS le, count(*) FILTER ({test}) AS bucket, count(*) AS total,
    {rounded('sum(execution_time_seconds)', 2)} AS seconds_sum FROM run_log WHERE execution_time_seconds IS NOT NULL GROUP BY pipeline_name"""
    for le, test in _BUCKETS), ["run_log"])
def metric_histogram(spark, sf_dir):
    return runlog.duration_histogram(runs(spark, sf_dir), "execution_time_seconds", ["pipeline_name"])


@query("metric_gauges", """SELECT pipeline_name, max_by(execution_time_seconds, (start_time, run_id)) FILTER (execution_time_seconds IS NOT NULL)
  AS execution_time_seconds, max_by(rows_loaded, (start_time, run_id)) AS rows_loaded FROM run_log GROUP BY pipeline_name""", ["run_log"])
def metric_gauges(spark, sf_dir):
    return runlog.gauges(runs(spark, sf_dir), ["pipeline_name"], ["execution_time_seconds", "rows_loaded"])
