"""Lineage neighbours, processed keys, watermarks, row append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope.functions.columns import col
from claimscope.operators import key_filter
from claimscope.operators.feature_table import latest
from claimscope.session import cut_lineage


def upsert_nodes(writes: DataFrame) -> DataFrame:
    """Nodes by id, last write wins."""
    return latest(writes, ["node_id"], ["written_at", "name", "source"])


def append_edges(edges: DataFrame | None, new: DataFrame, run_id: str) -> DataFrame:
    """Edges with the run that reported them; an edge reported again is there again."""
    stamped = new.withColumn("run_id", F.lit(run_id))
    return stamped if edges is None else edges.unionByName(stamped)


def append_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all tables, columns matched by name; duplicates stay."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def _neighbours(writes: DataFrame, edges: DataFrame, node_id: str, here: str, there: str) -> DataFrame:
    near = edges.filter(F.col(here) == node_id).select(F.col(there).alias("node_id"), "transformation")
    # only the nodes next to this one are brought up to date
    nodes = upsert_nodes(writes.join(near.select("node_id").distinct(), "node_id", "left_semi"))
    return near.join(nodes, "node_id")


def upstream(writes: DataFrame, edges: DataFrame, node_id: str) -> DataFrame:
    """Direct predecessors that exist as nodes, one row per edge."""
    return _neighbours(writes, edges, node_id, "to_node", "from_node")


def downstream(writes: DataFrame, edges: DataFrame, node_id: str) -> DataFrame:
    """Direct successors that exist as nodes, one row per edge."""
    return _neighbours(writes, edges, node_id, "from_node", "to_node")


def _reached(edges: DataFrame, node_id: str, here: str, there: str, hops: int | None) -> DataFrame:
    """Nodes reached from one, with the least number of steps to each, from 1. One round a step: the nodes found last are joined with
    the edges, those known already left out, so cycles end; all rounds read one stored copy of the edges' ends."""
    ends = cut_lineage(edges.select(F.col(here).alias("_from"), F.col(there).alias("node_id")).filter("_from <> node_id").distinct(), "lineage-edges")
    found = cut_lineage(ends.filter(F.col("_from") == node_id).select("node_id").distinct().withColumn("hops", F.lit(1)), "lineage-step")
    last, step = found, 1
    while (hops is None or step < hops) and not last.isEmpty():
        step += 1
        near = last.join(ends, last["node_id"] == ends["_from"]).select(ends["node_id"]).distinct()
        fresh = near.join(found.select("node_id"), "node_id", "left_anti").filter(F.col("node_id") != node_id)
        last = cut_lineage(fresh.withColumn("hops", F.lit(step)), "lineage-step")
        found = found.unionByName(last)
    return found


def _all_neighbours(writes: DataFrame, edges: DataFrame, node_id: str, here: str, there: str, hops: int | None) -> DataFrame:
    near = _reached(edges, node_id, here, there, hops)
    return near.join(upsert_nodes(writes.join(near.select("node_id"), "node_id", "left_semi")), "node_id")


def all_upstream(writes: DataFrame, edges: DataFrame, node_id: str, hops: int | None = None) -> DataFrame:
    """Every node that leads to this one, however far or within ``hops`` steps, with the least number of steps; nodes without a write
    are passed through and not shown, and neither is the node itself, even on a cycle."""
    return _all_neighbours(writes, edges, node_id, "to_node", "from_node", hops)


def all_downstream(writes: DataFrame, edges: DataFrame, node_id: str, hops: int | None = None) -> DataFrame:
    """Every node that this one leads to, as ``all_upstream`` the other way."""
    return _all_neighbours(writes, edges, node_id, "from_node", "to_node", hops)


def union_keys(processed: DataFrame, new: DataFrame) -> DataFrame:
    return processed.union(new).distinct()


def skip_processed(df: DataFrame, processed: DataFrame, key: str, known: DataFrame | None = None, blocks: int = key_filter.BLOCKS) -> DataFrame:
    """Rows whose key is not among the processed keys; a null key is a key like any other.

    ``known`` is a filter of the processed keys (``key_filter.build``, merged over all loads). Rows that it hasn't are new as they
    stand and don't move; only those that it may have meet the keys.
    """
    # repeats of a processed key fall away before the shuffle
    keys = processed.select(col(key).alias("_done")).distinct()
    same = col(key).eqNullSafe(F.col("_done"))
    if known is None:
        return df.join(keys, same, "left_anti")
    asked = key_filter.ask(df, key, known, blocks)
    fresh = asked.filter("NOT _may").drop("_may")
    return fresh.unionByName(asked.filter("_may").drop("_may").join(keys, same, "left_anti"))


def max_watermark(processed: DataFrame, key: str) -> DataFrame:
    """Greatest processed key; null when nothing was processed."""
    return processed.agg(F.max(col(key)).alias("watermark"))


def above_watermark(df: DataFrame, key: str, watermark: object | None) -> DataFrame:
    """Rows past the watermark, compared as the key's own type; all rows without one."""
    if watermark is None:
        return df
    return df.filter(col(key) > F.lit(watermark).cast(df.schema[key].dataType))
