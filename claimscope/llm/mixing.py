"""Mixing sources to target weights: water-filled targets, then Pareto order sampling inside each source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from claimscope.llm.common import stored, word_count

CELLS = 1024
#: The order of the rows of a source: by rank and id, then by the text's hash, and rows alike in all by a number of their own.
PLACE = ["rank", "no_id", "id", "tie", "lot", "row"]


def source_targets(sizes: DataFrame, share: float, weights: Sequence[float], cap: float) -> DataFrame:
    """``sizes`` (source, source_size, one row per source) with ``target``.

    Sources in code point order, null last, take ``weights`` in turn and share ``share`` times all sizes; no target
    passes ``cap`` times its source, and what is cut off goes to the others by weight. With sources sorted by cap per
    weight, those before some place are at their cap and the rest share what is left at one level.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") - 1) % len(weights) + 1)
    s = sizes.withColumn("place", place).withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    before = W.orderBy("ratio", "place").rowsBetween(W.unboundedPreceding, -1)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumn("rest", F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    s = s.withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("level", F.col("rest") / F.col("open"))
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(whole)["level"])
    target = F.when(F.col("level").isNull() | (F.col("ratio") <= F.col("level")), F.col("cap")).otherwise(F.col("level") * F.col("weight"))
    return s.select("source", "source_size", target.alias("target"))


def uniform(key: Column, seed: int) -> Column:
    """A number between 0 and 1, both left out, that follows from ``key`` and ``seed`` alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def _cell(ranked: DataFrame, budgets: DataFrame, rank: str) -> DataFrame:
    """Per source, the rows around the place in order of ``rank`` at which the running size passes the budget, with
    ``budget`` and what lies ``below`` them. ``budgets`` has what lies below all rows.

    ``rank`` lies in [0, 1). Each round sums sizes by (source, cell), finds the cell in which the budget is passed, and
    splits only that cell further, until the cells left hold few rows or no cell can be split.
    """
    at, scale = budgets.withColumn("cell", F.lit(0).cast("long")), 1

    def inside() -> DataFrame:
        return ranked.join(at.select(F.col("source").alias("_s"), F.col("cell").alias("_c"), "budget", "below"),
                           F.col("source").eqNullSafe(F.col("_s")) & (F.floor(F.col(rank) * F.lit(float(scale))) == F.col("_c"))).drop("_s", "_c")

    for _ in range(4):
        rows = inside()
        scale *= CELLS
        cells = rows.groupBy("source", "budget", "below", F.floor(F.col(rank) * F.lit(float(scale))).alias("cell")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        upto = W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
        cells = cells.withColumn("below", F.col("below") + F.coalesce(F.sum("words").over(upto), F.lit(0)))
        passed = cells.where(F.col("below") + F.col("words") > F.col("budget"))
        first = F.row_number().over(W.partitionBy("source").orderBy("cell"))
        at = stored(passed.withColumn("_k", first).where("_k = 1").select("source", "budget", "cell", "below", "n"), "mix-cells")
        if (at.agg(F.max("n")).first()[0] or 0) <= 10_000:
            break
    return inside()


def _cut(ranked: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source, the first row in order of ``PLACE`` with which the running size passes the budget.

    Rows of one rank and id (rows without an id, or that repeat one) are summed before they are ordered. Where the budget
    is passed inside such a block it is searched for by the hash of the text, and among equal hashes by a number that
    follows from the row, in the same way. So no task orders more than the distinct values of a cell.
    """
    at = budgets.withColumn("below", F.lit(0).cast("long"))
    for rank, keys in (("rank", ["no_id", "id"]), ("tie", []), ("lot", ["row"])):
        keys = [rank, *keys]
        rest = [c for c in PLACE if c not in keys]
        blocks = _cell(ranked, at, rank).groupBy("source", "budget", "below", *keys).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), *[F.min(c).alias(c) for c in rest])
        upto = W.partitionBy("source").orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
        blocks = blocks.withColumn("below", F.col("below") + F.coalesce(F.sum("size").over(upto), F.lit(0)))
        first = F.row_number().over(W.partitionBy("source").orderBy(*keys))
        found = stored(blocks.where("below + size > budget").withColumn("_k", first).where("_k = 1"), "mix-block")
        if (found.agg(F.max("n")).first()[0] or 0) <= 1:
            break
        same = found.select(*[F.col(c).alias(f"_{c}") for c in ("source", *keys)])
        alike = F.col("source").eqNullSafe(F.col("_source"))
        for c in keys:
            alike = alike & F.col(c).eqNullSafe(F.col(f"_{c}"))
        ranked, at = ranked.join(same, alike).select(ranked.columns), found.select("source", "budget", "below")
    return found.select("source", F.struct(*PLACE).alias("cut"), (F.col("budget") - F.col("below")).alias("gap"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5,
        weights: Sequence[float] = (5, 2, 1), cap: float = 2.0, seed: int = 7, row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``source``, ``size`` (words), ``source_size``, ``target``, ``copies``, ``taken``.

    ``target / source_size`` copies are due to each document. Its whole part is certain; the fraction p is an inclusion
    odds, and documents rank by the odds of a repeatable random number over it (Pareto order sampling). A source takes
    ranked documents up to the words still due, and in place of the document that would pass them the one document
    (or none) that comes nearest to what is left. So targets are met within about the smallest fitting document, no
    document comes more often than its due rounded up, and runs agree.

    Null texts have no words; a null source is a source of its own, last in order; null ids draw one shared number,
    as do rows that repeat an id. Each row still has a place of its own: among those of one draw and id, by a hash of
    the text, then by a number of the row; the cut goes between any two, and any may be the one extra. Documents
    without words, and sources with none but such, take part and add nothing. Extra columns are not read. An empty
    table gives an empty result. ``row_col``, a column with a number of its own for each row, comes first in the result.
    """
    row = F.col(f"`{row_col}`") if row_col else F.monotonically_increasing_id()
    rows = stored(docs.select(row.alias("row"),
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"),
        uniform(F.col(f"`{id_col}`"), seed).alias("u"), F.xxhash64(F.col(f"`{text_col}`")).alias("hash")), "mix-sizes")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), share, weights, cap)
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = targets.withColumn("due", due).withColumn("certain", F.floor("due").cast("int")).withColumn("p", F.col("due") - F.col("certain"))
    plan = stored(plan.withColumn("budget", F.col("target") - F.col("certain") * F.col("source_size")), "mix-targets")

    t = plan.withColumnRenamed("source", "_t")
    found = rows.join(t, F.col("source").eqNullSafe(F.col("_t"))).drop("_t")
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    found = found.withColumn("rank", F.when(F.col("p") > 0, odds / (1 + odds)))
    found = found.withColumns({"no_id": F.col("id").isNull(), "lot": F.shiftrightunsigned(F.xxhash64("row"), 11).cast("double") / F.lit(float(1 << 53)),
                               "tie": F.shiftrightunsigned("hash", 11).cast("double") / F.lit(float(1 << 53))})
    ranked = found.where("p > 0").select("source", "size", *PLACE)
    cuts = stored(_cut(ranked, plan.where("p > 0").select("source", "budget")), "mix-cuts")

    c = cuts.withColumnRenamed("source", "_s")
    after = F.struct(*PLACE) >= F.col("cut")
    off = F.abs(F.col("gap") - F.col("size"))
    late = ranked.join(c, F.col("source").eqNullSafe(F.col("_s"))).where(after & (off < F.col("gap")))
    extra = late.groupBy("source").agg(F.min(F.struct(off.alias("off"), *PLACE)).alias("best"))
    extra = extra.select(F.col("source").alias("_e"), F.col("best.row").alias("extra_row"))

    out = found.join(c, F.col("source").eqNullSafe(F.col("_s")), "left").join(extra, F.col("source").eqNullSafe(F.col("_e")), "left")
    best = F.col("row").eqNullSafe(F.col("extra_row"))
    drawn = (F.col("p") > 0) & (F.col("cut").isNull() | ~after | best)
    copies = F.col("certain") + F.coalesce(drawn, F.lit(False)).cast("int")
    shown = [F.col("row").alias(row_col)] if row_col else []
    return out.select(*shown, F.col("id").alias(id_col), "source", "size", "source_size", "target", copies.alias("copies"),
                      (F.col("size") * copies).alias("taken"))
