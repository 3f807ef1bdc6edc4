"""Record contracts: first failing rule per record, accepted rows, quarantine, schema comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.functions.columns import col
from claimscope.schema import CONTRACT_ENUMS, CONTRACT_NUMERIC, CONTRACT_REQUIRED, CONTRACTS, RAW_VALUES


def contract_error(df: DataFrame, version: str = "v1") -> Column:
    """Message of the first rule a record breaks, in fixed order; null for a valid record."""
    if version not in CONTRACTS:
        return F.lit(f"Unknown schema version: {version}")
    for field in CONTRACT_REQUIRED:
        if field not in df.columns:
            return F.lit(f"Missing required field: {field}")
    checks = []
    for field in ("policy_state", "incident_severity"):
        if field in df.columns:
            c = col(field)
            wrong = (c != "") & ~c.isin(RAW_VALUES[field])
            checks.append(F.when(wrong, F.concat(F.lit(f"Invalid {field}: "), c)))
    for field in CONTRACT_NUMERIC:
        if field in df.columns:
            c = col(field)
            if isinstance(df.schema[field].dataType, T.NumericType):
                checks.append(F.when(c < 0, f"Field {field} must be non-negative"))  # NaN is a number, and not below 0
            else:
                checks.append(F.when(c.isNotNull(), f"Field {field} must be numeric"))
    return F.coalesce(*checks)


def validate_records(df: DataFrame, version: str = "v1") -> DataFrame:
    """Add ``valid`` and ``error``."""
    return df.withColumn("error", contract_error(df, version)).withColumn("valid", F.col("error").isNull().cast("int"))


def enrich_records(df: DataFrame, at: Column | None = None, version: str = "v1") -> DataFrame:
    """Add ``valid``, ``errors``, ``validated_at``, and ``timestamp`` on valid records only."""
    at = F.current_timestamp() if at is None else at
    out = validate_records(df, version)
    return out.withColumns({
        "errors": F.when(F.col("error").isNull(), F.array().cast("array<string>")).otherwise(F.array("error")),
        "validated_at": at,
        "timestamp": F.when(F.col("error").isNull(), at),
    }).drop("error")


def split_records(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and the quarantine."""
    return validated.filter("valid = 1"), validated.filter("valid = 0")


_FITS = {
    "int": (T.IntegerType, T.LongType, T.ShortType, T.ByteType),
    "double": (T.DoubleType, T.FloatType),
    "string": (T.StringType,),
}


def compare_schema(df: DataFrame, version: str = "v1", fields: Sequence[tuple[str, str, bool]] | None = None) -> DataFrame:
    """One row per contract field: expected and actual type, nulls, values outside its symbols, and whether all fit.

    A version that is not known gives one row, for the field ``version``, that does not fit.
    """
    fields = CONTRACTS.get(version) if fields is None else fields
    if fields is None:
        return df.agg(F.count("*").alias("n")).select(
            F.lit("version").alias("field"), F.lit(", ".join(CONTRACTS)).alias("expected"), F.lit(version).alias("actual"),
            F.lit(0).cast("bigint").alias("nulls"), F.lit(0).cast("bigint").alias("unknown_symbols"), F.lit(0).alias("ok"))
    actual = {f.name: f.dataType for f in df.schema}
    present = [name for name, _, _ in fields if name in actual]
    symbols = {c: s for c, s in CONTRACT_ENUMS.get(version, {}).items() if c in present}
    facts = df.agg(
        F.count("*").alias("n"), *[F.count_if(col(c).isNull()).alias(f"null_{c}") for c in present],
        *[F.count_if(col(c).isNotNull() & ~col(c).cast("string").isin(s)).alias(f"odd_{c}") for c, s in symbols.items()])
    lines = []
    for name, expected, nullable in fields:
        fits = name in actual and isinstance(actual[name], _FITS[expected])
        empty = F.col(f"null_{name}") if name in actual else F.col("n")
        odd = F.col(f"odd_{name}") if name in symbols else F.lit(0).cast("bigint")
        lines.append(F.struct(
            F.lit(name).alias("field"), F.lit(expected).alias("expected"),
            F.lit(actual[name].simpleString() if name in actual else None).cast("string").alias("actual"),
            empty.alias("nulls"), odd.alias("unknown_symbols"),
            (F.lit(fits) & (F.lit(nullable) | (empty == 0)) & (odd == 0)).cast("int").alias("ok"),
        ))
    return facts.select(F.inline(F.array(*lines)))
