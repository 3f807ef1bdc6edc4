"""Exact top-k search in three phases: local score lists, a uniform cutoff that is safe, and exact scores of what is left."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from claimscope.llm.common import stored

#: Vectors in a block of the table, queries that are asked in one go, and the slices of dimensions that keep lists of their own.
ROWS, QUERIES, SLICES = 4096, 4096, 2
_TOO_LARGE = float(1 << 62)


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id`` and ``x`` (array of long): floor(scale * component). Rows with a null id, vector or component, or one that
    is not finite, are left out; rows that repeat an id are rows of their own."""
    v = F.col(f"`{vector_col}`")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL").where(
        ~F.exists("v", lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf")))))
    scaled = F.transform("v", lambda c: c.cast("double") * F.lit(float(scale)))
    return rows.select("id", F.transform(scaled, lambda c: F.when(F.abs(c) < F.lit(_TOO_LARGE), F.floor(c)).otherwise(
        F.raise_error(F.lit("a component is too large for scores that fit into a long")))).alias("x"))


def _matrix(lists: pa.ListArray, dims: int, kind: type) -> np.ndarray:
    """Lists as rows, short ones filled up with zeros."""
    ends = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]].astype(np.int64)
    lengths = np.diff(ends)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], lengths)] = flat
    return out.astype(kind)


def number_type(dims: int, most: int) -> type:
    """The fastest type in which all sums of products are exact, also times the number of slices."""
    bound = dims * most ** 2 * SLICES
    return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object


def _sliced(dims: int, edges: list[int], rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of rows cut into slices of dimensions: one row for each block and slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                x = _matrix(part.column(2), dims, np.int64)
                for s, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    cells = [part.column(0).to_numpy().astype("<i8").tobytes(), part.column(1).to_numpy().astype("<i8").tobytes(),
                             np.ascontiguousarray(x[:, a:b]).astype("<i8").tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), *[pa.array([c], pa.binary()) for c in cells]], ["slice", "rows", "ids", "data"])
    return run


def _asked(queries, edges: list[int], kind: type, pick: Callable, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Partial scores of one slice of one block at a time, for the queries of a broadcast ``queries`` (rows, ids, matrix)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_rows, q_ids, matrix = queries.value
        for batch in batches:
            for s, raw_rows, raw_ids, data in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                rows, ids = np.frombuffer(raw_rows, "<i8"), np.frombuffer(raw_ids, "<i8")
                a, b = edges[s], edges[s + 1]
                x = np.frombuffer(data, "<i8").reshape(len(rows), b - a).astype(kind)
                step = max(1, (1 << 22) // max(1, len(rows)))  # a bounded matrix of scores at a time
                for at in range(0, len(q_rows), step):
                    part = matrix[at:at + step, a:b].astype(kind) @ x.T
                    line, col = pick(at, part, q_ids[at:at + step, None] == ids[None, :])
                    if len(line):
                        cells = [q_rows[at + line], np.full(len(line), s, np.int32), rows[col], ids[col], part[line, col].astype(np.int64)]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names)
    return run


def _exact(pairs: DataFrame, table: DataFrame, asked: DataFrame) -> DataFrame:
    """``score`` of (query, row) pairs from the whole vectors. ``asked`` holds the queries of one go, a bounded number."""
    q = F.broadcast(asked.select(F.col("row").alias("query"), F.col("x").alias("_q")))
    products = F.zip_with("_q", "_v", lambda a, b: F.coalesce(a, F.lit(0)) * F.coalesce(b, F.lit(0)))
    met = pairs.join(table.select("row", F.col("x").alias("_v")), "row").join(q, "query")
    return met.select("query", "row", "id", F.aggregate(products, F.lit(0).cast("long"), lambda a, b: a + b).alias("score"))


def top_k(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256, rows: int = ROWS, queries: int = QUERIES) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each query id, the ``k`` rows of the highest inner product
    of floor(scale * component), ties to the smaller id, rows with the query's own id left out; all, if there are fewer.

    Blocks of rows are stored once, cut into slices of the dimensions; a list belongs to a block and a slice, and the task
    that makes it knows that slice's part of the scores only. Queries are asked in goes of about ``queries``, a broadcast of that
    size; a go is three phases over the blocks, so no product of queries and rows is ever moved or written.

    1. Each list sends its ``k`` best rows by its part of the score. The best ``k`` of each slice get their whole scores; the
       k-th best of those is a score that the result reaches at least.
    2. A row whose parts are all below that score over the number of slices cannot reach it. So that share is a safe
       cutoff, the same for all lists; each sends the rows that reach it.
    3. Rows sent by every slice have their score; of the others, those that may still reach it get theirs from their vectors.

    Rows that repeat an id are candidates, and queries, of their own. Vectors of different lengths are compared over the components both
    have; see ``whole_numbers`` for those that take no part. Scores are whole numbers and exact whatever the size of the components: in doubles
    where these can't lose a digit, else in 64-bit numbers; a score that a long can't hold ends the job with an error. Other columns
    are not read. No rows or no queries give an empty result.
    """
    spark = vectors.sparkSession
    table = stored(whole_numbers(vectors, id_col, vector_col, scale).withColumn("row", F.monotonically_increasing_id()).select("row", "id", "x"), "topk-vectors")
    n_asked, dims, most = table.agg(F.count(F.when(is_query(F.col("id")), 1)), F.max(F.size("x")),
                                    F.max(F.array_max(F.transform("x", lambda c: F.abs(c))))).first()
    dims = max(dims or 0, SLICES)
    kind, edges = number_type(dims, most or 0), [dims * s // SLICES for s in range(SLICES + 1)]
    blocks = stored(table.mapInArrow(_sliced(dims, edges, rows), "slice int, rows binary, ids binary, data binary"), "topk-blocks")
    goes = max(1, -(-n_asked // queries))
    wanted = table.where(is_query(F.col("id"))).withColumn("go", F.pmod(F.xxhash64("row"), F.lit(goes)))
    asking = stored(wanted.repartition("go").sortWithinPartitions("go"), "topk-queries") if goes > 1 else stored(wanted, "topk-queries")
    names, shape = ["query", "slice", "row", "id", "part"], "query long, slice int, row long, id long, part long"
    results = []
    for go in range(goes if n_asked else 0):
        asked = asking.where(F.col("go") == go)
        held = asked.select("row", "id", "x").toArrow().combine_chunks()
        if not held.num_rows:
            continue
        q_rows = held.column("row").to_numpy()
        sent = spark.sparkContext.broadcast((q_rows, held.column("id").to_numpy(), _matrix(held.column("x").combine_chunks(), dims, np.int64)))

        def best(_: int, part: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            take = min(part.shape[1], k + int(own.sum(axis=1).max(initial=0)))  # room for the query's own rows
            at = np.argpartition(-part, take - 1, axis=1)[:, :take] if take < part.shape[1] else np.tile(np.arange(take), (len(part), 1))
            line, col = np.repeat(np.arange(len(part)), take), at.ravel()
            good = ~own[line, col]
            return line[good], col[good]

        lists = blocks.mapInArrow(_asked(sent, edges, kind, best, names), shape)
        top = F.row_number().over(W.partitionBy("query", "slice").orderBy(F.desc("part"), "row"))
        first = stored(lists.withColumn("n", top).where(F.col("n") <= k).select("query", "row", "id").distinct(), "topk-lists")
        place = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "row"))
        reached = _exact(first, table, asked).withColumn("n", place).where(F.col("n") == k).select("query", F.col("score").alias("reached"))
        reached = stored(reached, "topk-reached")  # a row for each query of this go at most
        cut = {r["query"]: r["reached"] for r in reached.collect()}
        cutoffs = spark.sparkContext.broadcast([cut.get(r) for r in q_rows.tolist()])

        def enough(at: int, part: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            floors = cutoffs.value[at:at + len(part)]
            open_end = np.array([f is None for f in floors])
            floor = np.array([0 if f is None else f for f in floors], kind)
            return np.nonzero(((part * SLICES >= floor[:, None]) | open_end[:, None]) & ~own)

        entries = blocks.mapInArrow(_asked(sent, edges, kind, enough, names), shape)
        known = entries.groupBy("query", "row", "id").agg(F.sum("part").alias("known"), F.count(F.lit(1)).alias("parts"))
        known = known.join(F.broadcast(reached), "query", "left")
        missing, wide = F.lit(SLICES) - F.col("parts"), lambda c: F.col(c).cast("decimal(38,0)")
        # what is not known of a score is below the cutoff in each slice
        able = F.col("reached").isNull() | (wide("known") * SLICES + wide("reached") * missing >= wide("reached") * SLICES)
        known = stored(known.where(able), "topk-entries")
        whole = known.where(F.col("parts") == SLICES).select("query", "row", "id", F.col("known").alias("score"))
        rest = _exact(known.where(F.col("parts") < SLICES).select("query", "row", "id"), table, asked)
        scored = whole.unionByName(rest).join(F.broadcast(asked.select(F.col("row").alias("query"), F.col("id").alias("query_id"))), "query")
        rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "id"))
        results.append(stored(scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("id").alias("vec_id"), "score"), "topk-found"))
        sent.unpersist()
        cutoffs.unpersist()
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))  # queries may repeat an id
    return reduce(DataFrame.unionByName, results).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
