"""What several operators of this folder share: tables, stored steps, running totals, connected components."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from claimscope.session import cut_lineage

#: Fixed by the contracts: a word is a run of anything but space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder: a lost executor costs no recomputation of what lies before."""
    return cut_lineage(df, f"llm-{name}")


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_totals(df: DataFrame, order: Sequence[str], sums: dict[str, Column], name: str, within: Sequence[str] = ()) -> DataFrame:
    """``df`` with, for each name in ``sums``, the total over all earlier rows in ``order`` (the row's own left out).

    Rows go to even ranges of ``order``, are numbered and summed inside each range, and get the offset of their
    range from a table with one row per range. ``order`` must tell rows apart except where they are alike. With
    ``within``, leading columns of ``order``, totals start anew at each of their values.
    """
    placed = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    placed = stored(placed.withColumns({f"_{k}": v.cast("long") for k, v in sums.items()}), name)
    group = list(within)
    by_range = placed.groupBy(*group, "_range").agg(*[F.sum(f"_{k}").alias(f"_{k}_all") for k in sums])
    before = (W.partitionBy(*group) if group else W.partitionBy()).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = by_range.select(*[F.col(c).alias(f"_o_{c}") for c in [*group, "_range"]], *[
        F.coalesce(F.sum(f"_{k}_all").over(before), F.lit(0)).alias(f"_{k}_off") for k in sums])
    inside = W.partitionBy(*group, "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    summed = placed.withColumns({f"_{k}_in": F.coalesce(F.sum(f"_{k}").over(inside), F.lit(0)) for k in sums})
    same = F.lit(True)
    for c in [*group, "_range"]:
        same = same & summed[c].eqNullSafe(offsets[f"_o_{c}"])
    joined = summed.join(offsets, same)
    return joined.select(*df.columns, *[(F.col(f"_{k}_in") + F.col(f"_{k}_off")).alias(k) for k in sums])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component``: for every node of ``edges``, the smallest node it is connected with, itself included.

    Alternating large and small stars: every round is two min aggregates, which combine before the shuffle, and two
    joins, which adaptive execution splits where a node is hot; the number of rounds grows with the logarithm of the
    longest path. Rounds end when every node hangs on one other that hangs on none. Null ends and loops are left out.
    """
    def star(e: DataFrame, both: bool) -> DataFrame:
        pairs = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else e
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
        met = pairs.join(least, "u")
        if both:
            out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))

    def finished(e: DataFrame) -> bool:
        ends = e.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionAll(
            e.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
        at = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
        return at.where("below > 1 OR (below = 1 AND above = 1)").isEmpty()

    start = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = stored(start.distinct(), "edges")
    while not finished(current):
        current = stored(star(star(current, True), False).distinct(), "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
