"""Evaluation of scored rows ``(label, probability)``, decisions and bands, splits and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscope.functions.columns import hash_unit
from claimscope.functions.order import exact_percentiles, running_totals
from claimscope.schema import FRAUD_THRESHOLD, MIN_ACCURACY, MIN_AUC


def decision(probability: Column, threshold: float = FRAUD_THRESHOLD) -> Column:
    return (probability >= threshold).cast("int")


def confidence(probability: Column) -> Column:
    """On the unrounded probability."""
    return F.when((probability > 0.75) | (probability < 0.25), "high").otherwise("medium")


def risk_level(probability: Column) -> Column:
    """On the probability as shown, three digits rounded half to even."""
    shown = F.bround(probability, 3)
    return F.when(shown > 0.7, "HIGH").when(shown > 0.3, "MEDIUM").otherwise("LOW")


def decide(scored: DataFrame, threshold: float = FRAUD_THRESHOLD) -> DataFrame:
    """Add prediction, shown probability, confidence and risk to rows with a probability."""
    p = F.col("probability")
    return scored.withColumns({
        "prediction": decision(p, threshold), "fraud_probability": F.bround(p, 3),
        "confidence": confidence(p), "risk_level": risk_level(p),
    })


def accuracy(scored: DataFrame) -> DataFrame:
    return scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


def auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half.

    Rows are first aggregated to distinct scores; the count of negatives below each score is a
    running total over range buckets, so no task sees all scores.
    """
    y = F.col("label")
    scores = scored.groupBy(*by, "probability").agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    ranked = running_totals(scores, "probability", ["neg"], by)
    wins = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") + 0.5 * F.col("neg")))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.groupBy(*by).agg(F.try_divide(wins.cast("double"), pairs).alias("auc"))


def _cells() -> dict[str, Column]:
    y, p = F.col("label"), F.col("prediction")
    return {f"n{a}{b}": F.count_if((y == a) & (p == b)) for a in (0, 1) for b in (0, 1)}


def confusion(scored: DataFrame) -> DataFrame:
    """All four cells of the two-class table, empty ones included."""
    wide = scored.agg(*[c.alias(n) for n, c in _cells().items()])
    lines = [F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(f"n{a}{b}").alias("n"))
             for a in (0, 1) for b in (0, 1)]
    return wide.select(F.inline(F.array(*lines)))


def class_report(scored: DataFrame, digits: int = 6) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted averages."""
    w = scored.agg(*[c.alias(n) for n, c in _cells().items()])

    def share(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    for c, other in ((0, 1), (1, 0)):
        hit = F.col(f"n{c}{c}")
        w = w.withColumns({
            f"p{c}": share(hit, hit + F.col(f"n{other}{c}")),
            f"r{c}": share(hit, hit + F.col(f"n{c}{other}")),
            f"s{c}": hit + F.col(f"n{c}{other}"),
        })
        w = w.withColumn(f"f{c}", share(2 * F.col(f"p{c}") * F.col(f"r{c}"), F.col(f"p{c}") + F.col(f"r{c}")))
    total = F.col("s0") + F.col("s1")
    acc = share(F.col("n00") + F.col("n11"), total)

    def line(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), F.round(p, digits).alias("precision"), F.round(r, digits).alias("recall"),
                        F.round(f, digits).alias("f1"), s.alias("support"))

    def macro(k: str) -> Column:
        return (F.col(f"{k}0") + F.col(f"{k}1")) / 2

    def weighted(k: str) -> Column:
        return share(F.col(f"{k}0") * F.col("s0") + F.col(f"{k}1") * F.col("s1"), total)

    return w.select(F.inline(F.array(
        *[line(str(c), F.col(f"p{c}"), F.col(f"r{c}"), F.col(f"f{c}"), F.col(f"s{c}")) for c in (0, 1)],
        line("accuracy", acc, acc, acc, total),
        line("macro avg", macro("p"), macro("r"), macro("f"), total),
        line("weighted avg", weighted("p"), weighted("r"), weighted("f"), total),
    )))


def model_metrics(scored: DataFrame, feature_count: int) -> DataFrame:
    """Accuracy and AUC of three digits, and sample counts, as one row."""
    facts = scored.agg(
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
        F.count("*").alias("total_samples"),
        F.count_if(F.col("label") == 1).alias("fraud_samples"),
        F.count_if(F.col("label") == 0).alias("legitimate_samples"),
    )
    return facts.withColumns({
        "accuracy": F.bround("accuracy", 3), "auc_score": F.bround(auc(scored).scalar(), 3),
        "features_count": F.lit(feature_count),
    })


def gate(metrics: DataFrame, min_accuracy: float = MIN_ACCURACY, min_auc: float = MIN_AUC) -> DataFrame:
    """Add ``passed`` and the reason of a failure."""
    reason = F.when(F.col("accuracy") < min_accuracy, f"accuracy below {min_accuracy}").when(
        F.col("auc_score") < min_auc, f"AUC below {min_auc}")
    return metrics.withColumn("reason", reason).withColumn("passed", F.col("reason").isNull().cast("int"))


def require_gate(gated: DataFrame) -> None:
    row = gated.first()
    if not row["passed"]:
        raise ValueError(f"Model rejected: {row['reason']}")


def stratified_cuts(df: DataFrame, label: str, key: str, probs: Sequence[float], seed: int) -> dict[int, list[float | None]]:
    """Per class, the exact quantiles of the key hash: cut points that give exact class shares."""
    h = hash_unit(F.col(key), seed)
    cells = {str(c): F.when(F.col(label) == c, h) for c in (0, 1)}
    return {int(c): q for c, q in exact_percentiles(df, cells, probs, interpolate=False).items()}


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42, seen: DataFrame | None = None) -> DataFrame:
    """Add ``is_test``: the ``test_size`` share of each class with the least key hash.

    Repeatable, independent of row order, free of sorting; rows with one key stay together. ``seen``: the labels and keys of
    the same rows, where they are cheaper to read.
    """
    cuts = stratified_cuts(df if seen is None else seen, label, key, [test_size], seed)
    h = hash_unit(F.col(key), seed)
    test = F.lit(False)
    for c, (cut,) in cuts.items():
        if cut is not None:
            test = test | ((F.col(label) == c) & (h <= cut))
    return df.withColumn("is_test", test.cast("int"))


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 5, seed: int = 42, seen: DataFrame | None = None) -> DataFrame:
    """Add ``fold`` 0…``folds - 1`` with equal class shares. ``seen`` as in ``stratified_split``."""
    cuts = stratified_cuts(df if seen is None else seen, label, key, [i / folds for i in range(1, folds)], seed)
    h = hash_unit(F.col(key), seed)
    fold = F.lit(0)
    for c, edges in cuts.items():
        for edge in edges:
            if edge is not None:
                fold = fold + ((F.col(label) == c) & (h > edge)).cast("int")
    return df.withColumn("fold", fold)
