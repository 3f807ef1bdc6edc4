"""Distribution drift between a reference and a new dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscope.functions.columns import col
from claimscope.functions.order import exact_percentiles, running_totals, unpivot_values
from claimscope.functions.special import chi_square_pvalue, exact_ks_pvalue, kolmogorov_pvalue
from claimscope.operators.clean import numeric_columns, string_columns
from claimscope.session import cut_lineage
from claimscope.schema import DRIFT_THRESHOLD, PREDICTION_DRIFT_THRESHOLD, REFERENCE_PROBABILITY

# Advice per severity.
RECOMMENDATIONS = {
    "none": "Model is performing well. Continue monitoring.",
    "moderate": "Consider retraining model in next cycle.",
    "high": "Schedule immediate model retraining.",
    "critical": "URGENT: Retrain model before production use.",
}
EXCLUDED = ("policy_number",)
#: Values on either side up to which p-values are counted exactly: a quarter of a second a feature, at most.
EXACT_KS = 10_000


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean, sample deviation, least, greatest and exact quartiles per numeric column."""
    columns = numeric_columns(df) if columns is None else list(columns)
    quartiles = exact_percentiles(df, {c: col(c) for c in columns}, [0.25, 0.5, 0.75])
    wide = df.agg(*[
        F.struct(F.avg(col(c)).alias("mean"), F.stddev_samp(col(c)).alias("std"),
                 F.min(col(c)).cast("double").alias("min"), F.max(col(c)).cast("double").alias("max")).alias(f"s{i}")
        for i, c in enumerate(columns)
    ])
    lines = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"s{i}.{k}").alias(k) for k in ("mean", "std", "min", "max")],
                 *[F.lit(q).cast("double").alias(n) for n, q in zip(("q25", "q50", "q75"), quartiles[c], strict=True)])
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*lines)))


def category_counts(df: DataFrame, columns: Sequence[str], weights: dict[str, Column]) -> DataFrame:
    """Per feature and value the sum of each weight, nulls left out; one pass, one shuffle."""
    cells = unpivot_values(df, columns, keep=[w.alias(n) for n, w in weights.items()], cast="string")
    return cells.filter("value IS NOT NULL").groupBy("feature", "value").agg(*[F.sum(n).alias(n) for n in weights])


def profile_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Relative frequency of each value per text column, over its non-null rows."""
    columns = string_columns(df) if columns is None else list(columns)
    counts = category_counts(df, columns, {"n": F.lit(1)})
    filled = df.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    total = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(filled[f"n{i}"]))])
    return counts.select("feature", "value", (F.col("n") / total[F.col("feature")]).alias("share"))


def stack(ref: DataFrame, new: DataFrame, exclude: Sequence[str] = EXCLUDED) -> tuple[DataFrame, list[str], list[str]]:
    """Both datasets as one with weight columns ``ref`` and ``new``, and the shared features by kind."""
    shared = [c for c in ref.columns if c in new.columns and c not in exclude]
    numeric = [c for c in shared if c in numeric_columns(ref)]
    text = [c for c in shared if c in string_columns(ref)]
    one = ref.select(*[col(c).cast("double") for c in numeric], *text, F.lit(1).alias("ref"), F.lit(0).alias("new"))
    two = new.select(*[col(c).cast("double") for c in numeric], *text, F.lit(0).alias("ref"), F.lit(1).alias("new"))
    return one.unionByName(two), numeric, text


def value_counts(ref: DataFrame, new: DataFrame, exclude: Sequence[str] = EXCLUDED, numeric: bool = True, text: bool = True,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """``feature, number, value, ref, new``: how often each value of each shared feature occurs on either side.

    One pass over both sides for all features; a number has ``number``, a text ``value``, a missing value neither.
    The counts are stored: every statistic below is made from them. NaN counts as missing.
    """
    both, numbers, texts = stack(ref, new, exclude)
    chosen = [c for c in numbers if numeric] + [c for c in texts if text]
    chosen = [c for c in chosen if columns is None or c in columns]
    none_number, none_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    cells = [
        F.struct(F.lit(c).alias("feature"), (F.when(~F.isnan(col(c)), col(c)) if c in numbers else none_number).alias("number"),
                 (none_text if c in numbers else col(c).cast("string")).alias("value"), F.lit(int(c in numbers)).alias("numeric"))
        for c in chosen]
    if not cells:
        raise ValueError("the two sides share no feature")
    rows = both.select("ref", "new", F.inline(F.array(*cells)))
    return cut_lineage(rows.groupBy("feature", "numeric", "number", "value").agg(F.sum("ref").alias("ref"), F.sum("new").alias("new")), "drift")


def _sizes(counts: DataFrame) -> DataFrame:
    """Per feature all rows (``n_ref``, ``n_new``) and those with a value (``m``, ``n``) of either side; a row a feature."""
    filled = F.col("number").isNotNull() | F.col("value").isNotNull()
    return counts.groupBy("feature").agg(
        F.sum("ref").alias("n_ref"), F.sum("new").alias("n_new"),
        F.sum(F.when(filled, F.col("ref")).otherwise(0)).alias("m"), F.sum(F.when(filled, F.col("new")).otherwise(0)).alias("n"))


def _ranked(counts: DataFrame) -> DataFrame:
    """Distinct numbers of each feature with the running counts of both sides and the sizes of the feature, stored."""
    numbers = counts.filter("number IS NOT NULL").select("feature", "number", "ref", "new")
    return cut_lineage(running_totals(numbers, "number", ["ref", "new"], ["feature"]).join(_sizes(counts), "feature"), "ranked")


def _psi(ranked: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """Edges are the interpolated quantiles of the reference, read off its running counts."""
    picks = []
    for i in range(1, buckets):
        rank = (F.col("m") - 1) * F.lit(i / buckets)
        for name, r in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            here = (F.col("ref_upto") > r) & (F.col("ref_upto") - F.col("ref") <= r)
            picks.append(F.max(F.when(here, F.col("number"))).alias(f"{name}{i}"))
    found = ranked.groupBy("feature", "m").agg(*picks)
    edges = [(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * ((F.col("m") - 1) * F.lit(i / buckets) - F.floor((F.col("m") - 1) * F.lit(i / buckets)))).alias(f"e{i}")
             for i in range(1, buckets)]
    cut = ranked.join(found.select("feature", *edges), "feature")  # a row a feature
    spot = sum((F.coalesce((F.col("number") >= F.col(f"e{i}")).cast("int"), F.lit(0)) for i in range(1, buckets)), F.lit(0))
    bins = cut.groupBy("feature", spot.alias("bin")).agg(F.sum("ref").alias("ref"), F.sum("new").alias("new"))
    wide = _sizes(counts.filter("numeric = 1")).join(bins.groupBy("feature").agg(*[
        F.sum(F.when(F.col("bin") == b, F.col(s))).alias(f"{s}{b}") for b in range(buckets) for s in ("ref", "new")]), "feature", "left")
    return wide.select("feature", _index(buckets).alias("psi"))


def _index(buckets: int) -> Column:
    """The index from the counts ``ref0`` and ``new0``, ``ref1`` … of the bins and the sizes of both sides."""
    total = F.lit(0.0)
    for b in range(buckets):
        r = F.try_divide(F.coalesce(f"ref{b}", F.lit(0)).cast("double"), F.col("n_ref").cast("double"))
        n = F.try_divide(F.coalesce(f"new{b}", F.lit(0)).cast("double"), F.col("n_new").cast("double"))
        r, n = F.when(r == 0, 0.0001).otherwise(r), F.when(n == 0, 0.0001).otherwise(n)
        total = total + (n - r) * F.ln(n / r)
    return total


def _ks(ranked: DataFrame, exact_below: int = EXACT_KS) -> DataFrame:
    gap = F.abs(F.try_divide(F.col("ref_upto").cast("double"), F.col("m").cast("double"))
                - F.try_divide(F.col("new_upto").cast("double"), F.col("n").cast("double")))
    out = ranked.groupBy("feature", "m", "n").agg(F.max(gap).alias("ks_statistic"))
    asymptotic = kolmogorov_pvalue(F.col("ks_statistic"), F.col("m"), F.col("n"))
    small = {r["feature"]: exact_ks_pvalue(r["ks_statistic"], r["m"], r["n"])
             for r in out.filter((F.col("m").between(1, exact_below)) & (F.col("n").between(1, exact_below))).collect()}  # a row a feature
    if not small:
        return out.select("feature", "ks_statistic", asymptotic.alias("ks_pvalue"))
    exact = F.create_map(*[F.lit(x) for pair in small.items() for x in pair])
    return out.select("feature", "ks_statistic", F.coalesce(F.try_element_at(exact, F.col("feature")), asymptotic).alias("ks_pvalue"))


def _aligned(counts: DataFrame) -> DataFrame:
    texts = counts.filter("value IS NOT NULL").join(_sizes(counts), "feature")  # a row a feature
    share = {s: F.coalesce(F.try_divide(F.col(s).cast("double"), F.col(t).cast("double")), F.lit(0.0)) for s, t in (("ref", "m"), ("new", "n"))}
    return texts.select("feature", "value", share["ref"].alias("ref_share"), share["new"].alias("new_share"))


def psi(ref: DataFrame, new: DataFrame, columns: Sequence[str] | None = None, buckets: int = 10,
        exclude: Sequence[str] = EXCLUDED) -> DataFrame:
    """Population stability index per numeric feature over reference quantile bins.

    Bins are left-closed with open outer ends; a repeated edge sends its value to the last of
    its bins; shares are of all rows, nulls included; an empty share counts as 0.0001.
    """
    both, numbers, _ = stack(ref, new, exclude)
    chosen = [c for c in numbers if columns is None or c in columns]
    there = {c: F.when(~F.isnan(col(c)), col(c)) for c in chosen}
    # edges from a sketch and a look at what it leaves open, then one count: values are binned where they lie, and never shuffled
    edges = exact_percentiles(both.filter("ref = 1"), there, [i / buckets for i in range(1, buckets)])
    cells = []
    for c in chosen:
        spot = sum((F.coalesce((there[c] >= F.lit(e).cast("double")).cast("int"), F.lit(0)) for e in edges[c]), F.lit(0))
        cells.append(F.struct(F.lit(c).alias("feature"), F.when(there[c].isNotNull(), spot).alias("bin")))
    if not cells:
        raise ValueError("the two sides share no feature")
    bins = both.select("ref", "new", F.inline(F.array(*cells))).groupBy("feature", "bin").agg(F.sum("ref").alias("ref"), F.sum("new").alias("new"))
    wide = bins.groupBy("feature").agg(F.sum("ref").alias("n_ref"), F.sum("new").alias("n_new"), *[
        F.sum(F.when(F.col("bin") == b, F.col(s))).alias(f"{s}{b}") for b in range(buckets) for s in ("ref", "new")])
    return wide.select("feature", _index(buckets).alias("psi"))


def ks(ref: DataFrame, new: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = EXCLUDED, exact_below: int = EXACT_KS) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and p-value per numeric feature, from running totals over distinct values.

    The p-value is exact where neither side has more than ``exact_below`` values, and asymptotic above.
    """
    return _ks(_ranked(value_counts(ref, new, exclude, text=False, columns=columns)), exact_below)


def align_categories(ref: DataFrame, new: DataFrame, columns: Sequence[str] | None = None,
                     exclude: Sequence[str] = EXCLUDED) -> DataFrame:
    """Shares of every category seen in either dataset, 0 where it is absent.

    Both datasets are counted in one grouped pass, so aligning them needs no join.
    """
    return _aligned(value_counts(ref, new, exclude, numeric=False, columns=columns))


def chi_square(aligned: DataFrame) -> DataFrame:
    """Goodness of fit of the new shares to the reference shares, per feature.

    On shares, not counts; a category unknown to the reference makes the statistic infinite.
    """
    r, n = F.col("ref_share"), F.col("new_share")
    term = F.when((r == 0) & (n > 0), F.lit(float("inf"))).otherwise(F.try_divide((n - r) * (n - r), r))
    out = aligned.groupBy("feature").agg(F.sum(term).alias("chi2_statistic"), (F.count("*") - 1).cast("int").alias("df"))
    p = F.when(F.col("chi2_statistic") == float("inf"), 0.0).otherwise(chi_square_pvalue(F.col("chi2_statistic"), F.col("df")))
    return out.withColumn("chi2_pvalue", p)


def numeric_drift(counts: DataFrame, threshold: float = DRIFT_THRESHOLD, exact_below: int = EXACT_KS) -> DataFrame:
    ranked, none = _ranked(counts), F.lit(None).cast("double")
    both = _psi(ranked, counts, 10).join(_ks(ranked, exact_below), "feature")
    flag = ((F.col("psi") > threshold) | (F.col("ks_pvalue") < 0.05)).cast("int")
    return both.select("feature", "psi", "ks_statistic", "ks_pvalue", none.alias("chi2_statistic"), none.alias("chi2_pvalue"), flag.alias("drifted"))


def text_drift(counts: DataFrame) -> DataFrame:
    none = F.lit(None).cast("double")
    return chi_square(_aligned(counts)).select(
        "feature", none.alias("psi"), none.alias("ks_statistic"), none.alias("ks_pvalue"),
        "chi2_statistic", "chi2_pvalue", (F.col("chi2_pvalue") < 0.05).cast("int").alias("drifted"))


def feature_drift(ref: DataFrame, new: DataFrame, exclude: Sequence[str] = EXCLUDED, threshold: float = DRIFT_THRESHOLD,
                  numeric: bool = True, text: bool = True, exact_below: int = EXACT_KS) -> DataFrame:
    """One row per feature with its statistics and ``drifted``; both sides are read once, and only for the kinds asked for.

    ``exclude`` leaves out row keys: each new key is an unseen category and would always drift.
    """
    counts = value_counts(ref, new, exclude, numeric, text)
    parts = ([numeric_drift(counts, threshold, exact_below)] if numeric else []) + ([text_drift(counts)] if text else [])
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]


def overall(features: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Mean index over the drifted features, text features as 0, and its severity."""
    hit = F.col("drifted") == 1
    out = features.agg(
        F.count_if(hit).alias("drifted_features"),
        F.coalesce(F.avg(F.when(hit, F.coalesce("psi", F.lit(0.0)))), F.lit(0.0)).alias("overall_drift"))
    return out.withColumn("severity", severity(F.col("overall_drift"), threshold))


def severity(score: Column, threshold: float = DRIFT_THRESHOLD) -> Column:
    return F.when(score > 0.25, "critical").when(score > 0.15, "high").when(score > threshold, "moderate").otherwise("none")


def prediction_drift(ref_labels: DataFrame, predictions: DataFrame, reference_probability: float = REFERENCE_PROBABILITY) -> DataFrame:
    """Shift of the fraud rate and of the mean probability; one row.

    ``ref_labels`` has ``is_fraud``; ``predictions`` has ``prediction`` and ``probability``.
    """
    side = F.lit(None).cast("double")
    rows = ref_labels.select(F.col("is_fraud").cast("double").alias("ref"), side.alias("cur"), side.alias("p")).unionByName(
        predictions.select(side.alias("ref"), F.col("prediction").cast("double").alias("cur"), F.col("probability").cast("double").alias("p")))
    facts = rows.agg(F.avg("ref").alias("reference_fraud_rate"), F.avg("cur").alias("current_fraud_rate"),
                     F.avg("p").alias("current_avg_probability"))
    out = facts.withColumns({
        "reference_avg_probability": F.lit(reference_probability),
        "fraud_rate_change": F.abs(F.col("current_fraud_rate") - F.col("reference_fraud_rate")),
        "probability_change": F.abs(F.col("current_avg_probability") - F.lit(reference_probability)),
    })
    change = F.col("fraud_rate_change")
    return out.withColumns({
        "drift_detected": ((change > PREDICTION_DRIFT_THRESHOLD) | (F.col("probability_change") > 0.1)).cast("int"),
        "severity": F.when(change > 0.15, "critical").when(change > 0.10, "high").otherwise("none"),
    })


def recommendation(severity_column: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in RECOMMENDATIONS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, severity_column), F.lit("Unknown"))


def trend(log: DataFrame) -> DataFrame:
    """Whether the last score is above the first, mean and maximum; no row for fewer than two checks."""
    return log.agg(
        F.count("*").alias("checks"),
        (F.max_by("overall_drift", "checked_at") > F.min_by("overall_drift", "checked_at")).cast("int").alias("increasing"),
        F.avg("overall_drift").alias("mean_drift"), F.max("overall_drift").alias("max_drift"),
    ).filter("checks >= 2")


def report(log: DataFrame) -> DataFrame:
    """Latest check, number of checks, trend and advice; one row, none for an empty log."""
    out = log.agg(
        F.max_by(F.struct("overall_drift", "severity"), "checked_at").alias("latest"), F.max("checked_at").alias("checked_at"),
        F.count("*").alias("total_checks"),
        F.min_by("overall_drift", "checked_at").alias("first"),
        F.avg("overall_drift").alias("mean"), F.max("overall_drift").alias("most"),
    ).filter("total_checks > 0")
    known = F.col("total_checks") >= 2
    return out.select(
        "checked_at", F.col("latest.overall_drift").alias("overall_drift"), F.col("latest.severity").alias("severity"),
        "total_checks", F.when(known, (F.col("latest.overall_drift") > F.col("first")).cast("int")).alias("increasing"),
        F.when(known, F.col("mean")).alias("mean_drift"), F.when(known, F.col("most")).alias("max_drift"),
        recommendation(F.col("latest.severity")).alias("recommendation"))


def action(data: DataFrame, prediction: DataFrame) -> DataFrame:
    """Whether data drift or prediction drift calls for action; both inputs are one row."""
    return data.select(
        F.col("severity").alias("data_severity"), prediction.select("drift_detected").scalar().alias("prediction_drift"),
    ).withColumn("action_required", (F.col("data_severity").isin("moderate", "high", "critical")
                                     | (F.col("prediction_drift") == 1)).cast("int"))
