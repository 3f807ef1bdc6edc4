"""Engineered features and label encoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscope.functions.columns import col, flag
from claimscope.functions.order import running_totals
from claimscope.session import cut_lineage

# feature -> the input columns it needs
INPUTS = {
    "claim_to_premium_ratio": ("total_claim_amount", "policy_annual_premium"),
    "vehicle_property_ratio": ("vehicle_claim", "property_claim"),
    "injury_ratio": ("injury_claim", "total_claim_amount"),
    "tenure_age_ratio": ("months_as_customer", "age"),
    "no_witness_injury": ("bodily_injuries", "witnesses"),
    "complex_no_witness": ("number_of_vehicles_involved", "witnesses"),
    "deductible_claim_ratio": ("policy_deductable", "total_claim_amount"),
    "net_capital": ("capital-gains", "capital-loss"),
}


def _over(a: Column, b: Column) -> Column:
    """a / (b + 1): the plus one keeps the usual denominators away from 0."""
    return F.try_divide(a.cast("double"), b.cast("double") + 1)


def feature_columns(c: Mapping[str, Column]) -> dict[str, Column]:
    """Expressions of the features whose inputs ``c`` holds."""
    formulas = {
        "claim_to_premium_ratio": lambda a, b: _over(a, b),
        "vehicle_property_ratio": lambda a, b: _over(a, b),
        "injury_ratio": lambda a, b: _over(a, b),
        "tenure_age_ratio": lambda months, age: _over(months, age * 12),
        "no_witness_injury": lambda injuries, witnesses: flag((injuries > 0) & (witnesses == 0)),
        "complex_no_witness": lambda vehicles, witnesses: flag((vehicles > 1) & (witnesses == 0)),
        "deductible_claim_ratio": lambda a, b: _over(a, b),
        "net_capital": lambda gains, losses: gains.cast("double") - losses.cast("double"),
    }
    return {
        name: formulas[name](*[c[i] for i in inputs])
        for name, inputs in INPUTS.items() if all(i in c for i in inputs)
    }


def add_features(df: DataFrame) -> DataFrame:
    """Add each model feature whose input columns are there."""
    return df.withColumns(feature_columns({c: col(c) for c in df.columns}))


# What a missing input counts as in the feature table.
ROW_DEFAULTS = {
    "total_claim_amount": 0, "policy_annual_premium": 1, "vehicle_claim": 0, "property_claim": 1,
    "injury_claim": 0, "months_as_customer": 0, "age": 1, "bodily_injuries": 0, "witnesses": 0,
    "number_of_vehicles_involved": 1, "policy_deductable": 0, "capital-gains": 0, "capital-loss": 0,
}


def feature_rows(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The ten features of the feature table, missing inputs defaulted, raw claim kept as a struct."""
    inputs = {
        c: F.coalesce(col(c).cast("double"), F.lit(float(d))) if c in df.columns else F.lit(float(d))
        for c, d in ROW_DEFAULTS.items()
    }
    features = feature_columns(inputs)
    features["is_new_customer"] = flag(inputs["months_as_customer"] < 12)
    features["is_high_value_claim"] = flag(inputs["total_claim_amount"] > 20000)
    return df.select(
        *keep, *[c.alias(name) for name, c in features.items()],
        F.struct(*[col(c) for c in df.columns]).alias("_claim_data"),
    )


def fill_missing_features(df: DataFrame, model_columns: Sequence[str]) -> DataFrame:
    """Model columns the input lacks are added as 0, then the features are computed over them."""
    missing = {c: F.lit(0.0) for c in model_columns if c not in df.columns}
    return add_features(df.withColumns(missing) if missing else df)


def _text(column: str) -> Column:
    return F.coalesce(col(column).cast("string"), F.lit("nan"))


def fit_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Dictionary ``(feature, value, code)``: sorted distinct values numbered from 0, null as ``nan``.

    All columns in one pass; duplicates fall away before the shuffle, and the numbering is a
    running count over range buckets, so a column with very many values needs no single task.
    """
    cells = [F.struct(F.lit(c).alias("feature"), _text(c).alias("value")) for c in columns]
    values = df.select(F.inline(F.array(*cells))).distinct().withColumn("one", F.lit(1))
    numbered = running_totals(values, "value", ["one"], ["feature"])
    return numbered.select("feature", "value", (F.col("one_upto") - 1).cast("int").alias("code"))


#: Codes of a feature up to which they are looked up in a literal map; more codes make a join.
SMALL_DICTIONARY = 256


def encode_labels(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], stored: bool = False) -> DataFrame:
    """Replace text by its code; a value the dictionary lacks gets 0, the first class.

    The dictionary is written once, unless it is ``stored`` already. Features of few values, by a count of the stored
    dictionary, are looked up in the row; for the others, Spark broadcasts or shuffles a join by the stored size.
    """
    if not stored:
        dictionary = cut_lineage(dictionary, "labels")
    sizes = {r["feature"]: r["count"] for r in dictionary.groupBy("feature").count().collect()}
    small = [c for c in columns if sizes.get(c, 0) <= SMALL_DICTIONARY]
    codes: dict[str, list] = {c: [] for c in small}
    for r in dictionary.filter(F.col("feature").isin(small)).collect() if small else []:
        codes[r["feature"]] += [F.lit(r["value"]), F.lit(r["code"])]
    found = {c: F.coalesce(F.try_element_at(F.create_map(*pairs), _text(c)), F.lit(0)) if pairs else F.lit(0) for c, pairs in codes.items()}
    df = df.withColumns(found)
    for c in [c for c in columns if c not in small]:
        known = dictionary.filter(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        df = df.join(known, _text(c) == F.col("_value"), "left").withColumn(c, F.coalesce("_code", F.lit(0))).drop("_value", "_code")
    return df
