"""Fraud-rate reports, the ranked risk mart, histograms and paging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.functions.columns import col, percent
from claimscope.functions.order import running_totals
from claimscope.operators.clean import fraud_label


def frauds(column: str = "is_fraud") -> Column:
    return F.coalesce(F.sum(F.when(F.col(column) == 1, 1).otherwise(0)).cast("bigint"), F.lit(0).cast("bigint"))


def mean(column: str, digits: int = 2) -> Column:
    return F.round(F.avg(col(column).cast("double")), digits)


def money(column: str, digits: int = 4) -> Column:
    """Sum of an amount as a double, rounded only at the end; averages are taken from the amounts, not from this."""
    return F.round(F.sum(col(column).cast("double")), digits)


def exact_mean(column: str) -> Column:
    """Mean of an amount from its exact decimal sum, which no order of adding changes; it isn't rounded. Amounts count to eight digits."""
    total = F.sum(col(column).try_cast("decimal(30,8)")).cast("double")
    return F.try_divide(total, F.count(column).cast("double"))


def fraud_rate(
    df: DataFrame,
    by: Sequence[str | Column] = (),
    scale: float = 100,
    digits: int = 2,
    extra: Mapping[str, Column] | None = None,
    total: str = "total_claims",
    rate: str | None = "fraud_rate",
) -> DataFrame:
    """Claims, frauds and fraud rate per group; one partially aggregated shuffle.

    ``scale`` and ``digits`` choose between a percentage and a fraction.
    """
    out = df.groupBy(*by).agg(
        F.count("*").alias(total),
        frauds().alias("fraud_count"),
        *[c.alias(name) for name, c in (extra or {}).items()],
    )
    if rate:
        out = out.withColumn(rate, percent(F.col("fraud_count"), F.col(total), scale, digits))
    return out


def top_makes(df: DataFrame, more_than: int = 50, k: int = 5) -> DataFrame:
    return (
        fraud_rate(df, ["auto_make"])
        .filter(F.col("total_claims") > more_than)
        .orderBy(F.desc("fraud_rate"), "auto_make")
        .limit(k)
    )


def witness_status() -> Column:
    return F.when(F.col("witnesses") == 0, "No Witnesses").otherwise("Has Witnesses").alias("witness_status")


def label_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, fraud_label(F.col("is_fraud")).alias("fraud_label")).agg(F.count("*").alias("claim_count"))


def kpis(df: DataFrame) -> DataFrame:
    return fraud_rate(df, scale=100, digits=1, extra={"avg_claim_amount": mean("total_claim_amount", 2)}).withColumn(
        "fraud_rate", F.coalesce("fraud_rate", F.lit(0.0))
    )


def rank_rows(df: DataFrame, value: str, ties: Sequence[str], name: str) -> DataFrame:
    """Row number over the whole table, ``value`` descending then ``ties``, without a single-task sort; null comes last."""
    order = F.struct(F.coalesce(-F.col(value), F.lit(float("inf"))).alias("v"), *ties)
    numbered = df.withColumns({"_order": order, "_one": F.lit(1).cast("bigint")})
    return running_totals(numbered, "_order", ["_one"]).withColumnRenamed("_one_upto", name).drop("_order", "_one")


def risk_band(rate: Column) -> Column:
    return F.when(rate >= 0.2, "HIGH_RISK").when(rate >= 0.1, "MEDIUM_RISK").otherwise("LOW_RISK")


MART_KEYS = ["auto_make", "incident_severity", "age_group", "tenure_group"]


def fraud_groups(staged: DataFrame) -> DataFrame:
    """Groups of the risk mart, with the fraud rate as a fraction of three digits."""
    keyed = staged.drop("incident_severity").withColumnRenamed("incident_severity_clean", "incident_severity")
    return fraud_rate(keyed, MART_KEYS, scale=1, digits=3, extra={
        "avg_claim_amount": exact_mean("total_claim_amount"),
        "avg_premium": exact_mean("policy_annual_premium"),
        "total_claim_value": money("total_claim_amount"),
    })


def fraud_summary(staged: DataFrame) -> DataFrame:
    """The risk mart: group figures, risk band and rank, both on the rounded rate."""
    groups = fraud_groups(staged).withColumn("risk_category", risk_band(F.col("fraud_rate")))
    return rank_rows(groups, "fraud_rate", MART_KEYS, "fraud_rank").orderBy(F.desc("fraud_rate"), "fraud_rank")


def histogram(df: DataFrame, column: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins 1…``bins`` between the least and greatest value; the greatest is in the last."""
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    if lo is None:
        return df.limit(0).groupBy(F.lit(0).alias("bin"), *by).agg(F.count("*").alias("n"))
    spot = F.lit(1) if hi == lo else F.least(
        F.floor(F.lit(bins) * (F.col(column) - F.lit(lo)) / (F.lit(hi) - F.lit(lo))) + 1, F.lit(bins)
    ).cast("int")
    return df.filter(F.col(column).isNotNull()).groupBy(spot.alias("bin"), *by).agg(F.count("*").alias("n"))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sorted distinct non-null values of each column, all columns in one pass."""
    cells = [F.struct(F.lit(c).alias("filter_name"), col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*cells)))
        .filter("value IS NOT NULL").distinct().orderBy("filter_name", "value")
    )


def page(df: DataFrame, order: Sequence[str | Column], limit: int = 100, offset: int = 0, most: int = 1000) -> DataFrame:
    """One page of a table, in ``order`` and then by all other columns that can be ordered, so that pages neither overlap
    nor miss rows: rows that still tie are alike."""
    if not 1 <= limit <= most or offset < 0:
        raise ValueError(f"limit must be 1..{most} and offset not negative")
    rest = [col(c) for c in df.columns if c not in order and not isinstance(df.schema[c].dataType, T.MapType)]
    return df.orderBy(*order, *rest).offset(offset).limit(limit)


def batch_summary(scored: DataFrame) -> DataFrame:
    out = scored.agg(
        F.count("*").alias("total_predictions"),
        F.coalesce(F.count_if(F.col("prediction") == 1), F.lit(0)).alias("fraud_count"),
    )
    return out.select(
        "total_predictions", "fraud_count",
        (F.col("total_predictions") - F.col("fraud_count")).alias("legitimate_count"),
        percent(F.col("fraud_count"), F.col("total_predictions"), 100, 1).alias("fraud_rate"),
    )


def restore_check(df: DataFrame) -> DataFrame:
    """Row count, frauds, the rest, and fraud percentage (0 for an empty table)."""
    out = df.agg(F.count("*").alias("claims_count"), F.coalesce(F.sum("is_fraud"), F.lit(0)).cast("bigint").alias("fraud_count"))
    return out.select(
        "claims_count", "fraud_count",
        (F.col("claims_count") - F.col("fraud_count")).alias("legitimate_count"),
        F.coalesce(percent(F.col("fraud_count"), F.col("claims_count"), 100, 1), F.lit(0.0)).alias("fraud_rate"),
    )


def class_balance(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    out = df.agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count("*").alias("total"),
    )
    return out.withColumn("ratio", F.try_divide(F.col("negatives").cast("double"), F.col("positives").cast("double")))
