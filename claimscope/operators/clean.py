"""Cleaning: junk columns, missing values, text case, bins, target, canonical projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.functions.columns import bin_column, col, flag, strip, title_case, to_number
from claimscope.functions.order import exact_percentiles
from claimscope.schema import (
    AGE_EDGES, AGE_LABELS, DERIVED_COLUMNS, FINAL_COLUMNS, TENURE_EDGES, TENURE_LABELS,
)

UNTOUCHED_TEXT = ("fraud_reported",)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def drop_junk(df: DataFrame) -> DataFrame:
    """Drop every column whose name starts with an underscore."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def fit_medians(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, float | None]:
    """Exact median per numeric column: the statistics a cleaned batch or stream is filled with."""
    columns = numeric_columns(df) if columns is None else columns
    return {c: q[0] for c, q in exact_percentiles(df, {c: col(c) for c in columns}, [0.5]).items()}


def fill_median(df: DataFrame, medians: Mapping[str, float | None] | None = None) -> DataFrame:
    """Numeric columns as doubles, nulls replaced by the median of the column.

    Cast comes first: a median such as 45.5 must not be cut to fit an integer column.
    """
    columns = numeric_columns(df)
    medians = fit_medians(df, columns) if medians is None else medians
    return df.withColumns({
        c: F.coalesce(col(c).cast("double"), F.lit(medians.get(c)).cast("double")) for c in columns
    })


def fill_unknown(df: DataFrame) -> DataFrame:
    return df.na.fill("Unknown", subset=string_columns(df))


def title_text(df: DataFrame) -> DataFrame:
    """Trim and title-case every text column but the raw target, keys included."""
    return df.withColumns({
        c: title_case(strip(col(c))) for c in string_columns(df) if c not in UNTOUCHED_TEXT
    })


def derive_has_claim(df: DataFrame) -> DataFrame:
    return df.withColumn("has_claim", flag(F.col("total_claim_amount") > 0))


def derive_age_group(df: DataFrame) -> DataFrame:
    return df.withColumn("age_group", bin_column(F.col("age"), AGE_EDGES, AGE_LABELS))


def derive_tenure_group(df: DataFrame) -> DataFrame:
    return df.withColumn("tenure_group", bin_column(F.col("months_as_customer"), TENURE_EDGES, TENURE_LABELS))


def encode_target(df: DataFrame) -> DataFrame:
    return df.withColumn("is_fraud", flag(F.col("fraud_reported") == "Y"))


_DERIVATIONS = {
    "has_claim": derive_has_claim,
    "age_group": derive_age_group,
    "tenure_group": derive_tenure_group,
    "is_fraud": encode_target,
}


def project_final(df: DataFrame) -> DataFrame:
    return df.select(*[col(c) for c in FINAL_COLUMNS if c in df.columns])


def transform_claims(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    medians: Mapping[str, float | None] | None = None,
) -> DataFrame:
    """The whole cleaning chain; one narrow projection once the medians are known.

    ``columns`` limits the result to some canonical columns, and with it the statistics that
    are computed. ``medians`` skips computing them: streams and incremental loads pass stored ones.
    """
    wanted = FINAL_COLUMNS if columns is None else list(columns)
    inputs = {DERIVED_COLUMNS.get(c, c) for c in wanted}
    df = drop_junk(df)
    df = df.select(*[col(c) for c in df.columns if c in inputs])
    df = title_text(fill_unknown(fill_median(df, medians)))
    for name, derive in _DERIVATIONS.items():
        if name in wanted and DERIVED_COLUMNS[name] in df.columns:
            df = derive(df)
    return project_final(df).select(*[col(c) for c in FINAL_COLUMNS if c in wanted and c in df.columns])


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Listed columns as numbers; what does not parse becomes null."""
    return df.withColumns({c: to_number(col(c)) for c in columns if c in df.columns})


def staging_view(df: DataFrame) -> DataFrame:
    """Cleaned claims with plain column names, lower-case copies and null-safe ratios."""
    renamed = {"capital-gains": "capital_gains", "capital-loss": "capital_loss"}

    def ratio(a: str, b: str) -> Column:
        return F.try_divide(F.col(a).cast("double"), F.nullif(F.col(b).cast("double"), F.lit(0.0)))

    return df.select(
        *[col(c).alias(renamed.get(c, c)) for c in FINAL_COLUMNS],
        F.trim(F.lower("policy_state")).alias("policy_state_clean"),
        F.trim(F.lower("incident_severity")).alias("incident_severity_clean"),
        ratio("total_claim_amount", "policy_annual_premium").alias("claim_to_premium_ratio"),
        ratio("vehicle_claim", "total_claim_amount").alias("vehicle_claim_ratio"),
        ratio("injury_claim", "total_claim_amount").alias("injury_claim_ratio"),
    )


def fraud_only(df: DataFrame, enabled: bool = True) -> DataFrame:
    return df.filter("is_fraud = 1") if enabled else df


def browse(df: DataFrame, severity: str = "All", status: str = "All", make: str = "All",
           columns: Sequence[str] | None = None) -> DataFrame:
    """Up to three equality filters, ANDed; ``All`` leaves a filter out."""
    if severity != "All":
        df = df.filter(F.col("incident_severity") == severity)
    if status == "Fraud Only":
        df = df.filter("is_fraud = 1")
    elif status == "Legitimate Only":
        df = df.filter("is_fraud = 0")
    if make != "All":
        df = df.filter(F.col("auto_make") == make)
    return df.select(*[col(c) for c in columns if c in df.columns]) if columns else df


def drop_null_pairs(df: DataFrame, first: str, second: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.dropna(subset=[first, second]).select(first, second, *keep)


def fraud_label(c: Column) -> Column:
    return F.when(c == 0, "Legitimate").when(c == 1, "Fraud")
