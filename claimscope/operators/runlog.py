"""Run history: trends, retention, due checks, health and metric roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscope.schema import RERUN_HOURS, RETAINED_RUNS

# Upper bounds of the default duration histogram, in seconds.
DURATION_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]


def successes(runs: DataFrame) -> DataFrame:
    return runs.filter("status = 'success'")


def last_values(runs: DataFrame, metric: str, n: int = 7) -> DataFrame:
    """A metric over the last ``n`` successful runs, oldest first, missing as 0."""
    newest = successes(runs).select("run_id", "start_time", F.coalesce(metric, F.lit(0)).alias("value"))
    newest = newest.orderBy(F.desc("start_time"), F.desc("run_id")).limit(n)
    return newest.orderBy("start_time", "run_id")


def retain(runs: DataFrame, keep: int = RETAINED_RUNS) -> DataFrame:
    """The newest ``keep`` successes and failures. The limit is applied in every task before
    the shuffle (window group limit), so at most ``keep`` rows per kind and task move."""
    newest = Window.partitionBy("status").orderBy(F.desc("start_time"), F.desc("run_id"))
    return (
        runs.filter("status IN ('success', 'failed')")
        .withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= keep).drop("_n")
    )


def seconds_since(then: Column, now: Column) -> Column:
    return F.timestamp_diff("SECOND", then, now)


def age_text(then: Column, now: Column) -> Column:
    s = seconds_since(then, now)

    def text(unit: int, suffix: str) -> Column:
        return F.concat(F.floor(s / unit).cast("bigint").cast("string"), F.lit(suffix))

    return (
        F.when(then.isNull(), "Never").when(s >= 86400, text(86400, "d ago"))
        .when(s > 3600, text(3600, "h ago")).otherwise(text(60, "m ago"))
    )


def last_success(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Time and id of the last successful run, per group if asked; null where there is none."""
    ok = F.col("status") == "success"
    run = F.max(F.when(ok, F.struct("start_time", "run_id")))
    return runs.groupBy(*by).agg(run.alias("_run"), F.count_if(ok).alias("processed")).select(
        *by, F.col("_run.start_time").alias("last_time"), F.col("_run.run_id").alias("last_run_id"), "processed")


def latest_run(runs: DataFrame, now: Column) -> DataFrame:
    return last_success(runs).withColumn("age", age_text(F.col("last_time"), now)).filter("last_time IS NOT NULL")


def due(runs: DataFrame, now: Column, hours: int = RERUN_HOURS) -> DataFrame:
    """Per pipeline: due if it never succeeded, or not within ``hours``."""
    out = last_success(runs, ["pipeline_name"])
    late = seconds_since(F.col("last_time"), now) >= hours * 3600
    return out.select("pipeline_name", "last_time", F.coalesce(late, F.lit(True)).cast("int").alias("due"))


def recent(runs: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    return runs.filter(F.col("start_time") > now - F.expr(f"INTERVAL {int(hours)} HOURS"))


def success_rate() -> Column:
    return F.coalesce(F.avg((F.col("status") == "success").cast("double")), F.lit(1.0))


def mean_seconds() -> Column:
    return F.coalesce(F.avg("execution_time_seconds"), F.lit(0.0))


def health_report(runs: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    facts = recent(runs, now, hours).agg(
        success_rate().alias("rate"), mean_seconds().alias("seconds"), F.count("*").alias("total_runs"))
    return facts.select(
        F.round(F.col("rate") * 100, 1).alias("success_rate"), F.round("seconds", 1).alias("avg_execution_time"),
        "total_runs", F.when(F.col("rate") >= 0.9, "healthy").otherwise("degraded").alias("health"))


def counters(runs: DataFrame, labels: Sequence[str], sums: Sequence[str]) -> DataFrame:
    return runs.groupBy(*labels).agg(
        F.count("*").alias("runs_total"), *[F.sum(s).cast("bigint").alias(f"{s}_total") for s in sums])


def duration_histogram(runs: DataFrame, value: str, labels: Sequence[str], bounds: Sequence[float] = DURATION_BUCKETS) -> DataFrame:
    """Cumulative bucket counts, sum and count per label set; one row per bucket bound."""
    v = F.col(value)
    wide = runs.filter(v.isNotNull()).groupBy(*labels).agg(
        *[F.count_if(v <= le).alias(f"b{i}") for i, le in enumerate(bounds)],
        F.count("*").alias("total"), F.round(F.sum(v), 2).alias("seconds_sum"))
    lines = [F.struct(F.lit(str(le)).alias("le"), F.col(f"b{i}").alias("bucket")) for i, le in enumerate(bounds)]
    lines.append(F.struct(F.lit("+Inf").alias("le"), F.col("total").alias("bucket")))
    return wide.select(*labels, F.inline(F.array(*lines)), "total", "seconds_sum")


def gauges(runs: DataFrame, labels: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The value set last, per label set; nulls do not set a gauge."""
    return runs.groupBy(*labels).agg(*[
        F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.struct("start_time", "run_id"))).alias(v) for v in values])
