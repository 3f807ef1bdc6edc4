"""Exact dedup by skew-safe combining: locally, in salted digest groups, then over all salt winners."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from claimscope.llm.common import stored


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64,
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id`` (largest id of its group), ``group_size``, ``kept``, ``text_sha256``.

    1. Each input partition combines its equal texts before anything is shuffled, as a partial aggregate by (digest,
       salt, text), the salt following from the partition; salted groups then merge what several partitions found.
       However many copies a text has, a group receives at most one row from each partition that falls to its salt.
    2. The salt winners combine by (digest, text), at most ``salts`` rows for each text.
    3. Rows get their winner back by digest alone: stage 2 has compared the whole texts of all rows, so a digest with
       one text stands for it. Should a digest have several texts, its rows are joined by digest and text.

    Null texts count as empty, which is a text like any other. Ids that are null lose to any other; a group with none
    but null ids keeps null, and ``kept`` is then true for all of it. Rows that repeat id and text are one document and
    share their fate, though each counts in ``group_size``. Other columns are not read, so their names don't matter. An
    empty table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text.alias("_text"))
    rows = rows.withColumn("_sha", sha256(F.col("_text")))
    rows = rows.withColumn("_digest", F.col("_sha") if digest is sha256 else digest(F.col("_text")))

    salted = rows.withColumn("_salt", F.spark_partition_id() % salts)
    local = salted.groupBy("_digest", "_salt", "_text").agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    merged = local.groupBy("_digest", "_text").agg(F.max("_keep").alias("keep_id"), F.sum("_n").alias("group_size"))
    winners = stored(merged.select("_digest", "keep_id", "group_size"), "exact-winners")

    shared = winners.groupBy("_digest").count().where("count > 1").select("_digest")
    found = rows.select("_id", "_sha", "_digest").join(winners, "_digest")
    if not shared.isEmpty():
        clear = found.join(shared, "_digest", "left_anti")
        mixed = rows.join(shared, "_digest", "left_semi")
        by_text = mixed.groupBy("_digest", "_text").agg(F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        found = clear.unionByName(mixed.join(by_text, ["_digest", "_text"]).select(clear.columns))
    return found.select(
        F.col("_id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("_sha").alias("text_sha256"))
