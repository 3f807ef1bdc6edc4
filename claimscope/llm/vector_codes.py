"""Vector code compression: product codes from codebooks that are refined over lexicographic tries of distinct parts.

The parts of the vectors are put in lexicographic order, equal ones together with a weight. In a trie of them, all parts
below a node share their first components, so the distances from those components to every entry are summed once for the node
and handed down depth first; a leaf adds what its own components bring, takes the nearest entry, and its weighted sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimscope.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors whose parts share a trie, and children of a node that are summed at once.
BLOCK, WIDE = 1 << 15, 1 << 10
#: Components from here on can't have distances that a long holds.
_TOO_LARGE = float(1 << 62)


def whole_components(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None, scale: int) -> DataFrame:
    """``id``, ``label``, ``x`` (array of long): floor(scale * component). Rows whose vector is null or holds a component
    that is null or not finite are left out."""
    v = F.col(f"`{vector_col}`")
    label = F.col(f"`{label_col}`") if label_col else F.lit(None).cast("int")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.alias("label"), v.alias("v")).where("v IS NOT NULL")
    fine = rows.where(~F.exists("v", lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf")))))
    scaled = F.transform("v", lambda c: c.cast("double") * F.lit(float(scale)))
    whole = F.transform(scaled, lambda c: F.when(F.abs(c) < F.lit(_TOO_LARGE), F.floor(c)).otherwise(
        F.raise_error(F.lit("a component is too large for distances that fit into a long"))))
    return fine.select("id", "label", whole.alias("x"))


def exact_type(dims: int, most: int) -> type:
    """The narrowest type that holds the squared distance of any two parts with components up to ``most``."""
    bound = dims * (2 * most) ** 2
    return np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 63 else object


def trie_nearest(parts: np.ndarray, book: np.ndarray, wide: int = WIDE) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of ``book`` (ties to the lower one) and squared distance to it for each row of ``parts``, which are
    distinct and in lexicographic order.

    Depth first: the stack holds nodes of the trie with more than one leaf: a run of rows, the depth of its common prefix,
    and the distances of that prefix to all entries. Children of a node are summed at once, ``wide`` at a time; those with a
    single leaf are finished at once over their remaining dimensions. So the stack holds one vector of distances for each
    open node, and a block of them for the leaves.
    """
    n, dims = parts.shape
    nearest, error = np.zeros(n, np.int64), np.zeros(n, parts.dtype)

    def finish(rows: np.ndarray, reached: np.ndarray, depth: int) -> None:
        for d in range(depth, dims):
            step = parts[rows, d][:, None] - book[:, d][None, :]
            step *= step
            reached += step
        best = reached.argmin(axis=1)
        nearest[rows], error[rows] = best, reached[np.arange(len(rows)), best]

    stack = [(0, n, 0, np.zeros(len(book), parts.dtype))] if n else []
    while stack:
        low, high, depth, prefix = stack.pop()
        if depth == dims:
            finish(np.array([low]), prefix[None, :].copy(), depth)
            continue
        column = parts[low:high, depth]
        starts = np.concatenate([[0], np.flatnonzero(column[1:] != column[:-1]) + 1])
        ends = np.append(starts[1:], high - low)
        deeper = []
        for at in range(0, len(starts), wide):
            s, e = starts[at:at + wide], ends[at:at + wide]
            step = column[s][:, None] - book[:, depth][None, :]
            step *= step
            step += prefix
            single = e - s == 1
            if single.any():
                finish(low + s[single], step[single], depth + 1)
            for i in np.flatnonzero(~single).tolist():
                deeper.append((low + int(s[i]), low + int(e[i]), depth + 1, step[i].copy()))
        stack.extend(reversed(deeper))
    return nearest, error


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists as rows of a matrix, short ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]].astype(np.int64)
    lengths = np.diff(ends)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], lengths)] = flat
    return out


def _tries(parts: int, width: int, block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of vectors as, for each part position, the distinct parts in order, their weights, and which one each vector has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            x = _matrix(table.column("x"), parts * width)
            cut = []
            for p in range(parts):
                own = np.ascontiguousarray(x[:, p * width:(p + 1) * width])
                order = np.lexsort(own.T[::-1]) if width else np.arange(len(own))
                ordered = own[order]
                new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])
                place = np.empty(len(own), np.int32)
                place[order] = np.cumsum(new) - 1
                cut.append({"distinct": ordered[new].astype("<i8").tobytes(), "place": place.astype("<i4").tobytes()})
            ids = pa.Table.from_batches(held).select(["id", "label"])
            listed = [pa.ListArray.from_arrays([0, ids.num_rows], ids.column(c).combine_chunks()) for c in ("id", "label")]
            kind = pa.list_(pa.struct([("distinct", pa.binary()), ("place", pa.binary())]))
            return pa.RecordBatch.from_arrays([*listed, pa.array([cut], kind)], ["ids", "labels", "parts"])

        for batch in batches:
            while batch.num_rows:
                take = batch.slice(0, block - rows)
                held.append(take)
                rows, batch = rows + take.num_rows, batch.slice(take.num_rows)
                if rows == block:
                    yield close()
                    held, rows = [], 0
        if rows:
            yield close()
    return run


def _of_block(part: dict, width: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
    place = np.frombuffer(part["place"], "<i4")
    distinct = np.frombuffer(part["distinct"], "<i8").reshape(-1, width) if width else np.zeros((1, 0), np.int64)
    return (distinct.astype(object) if kind is object else distinct.astype(kind)), place


def _sums(books: list[np.ndarray], kind: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For every entry that is the nearest of some part: how many, and the sum of each component; a decimal holds any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = books[0].shape[1]
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, object) for b in books]
        for batch in batches:
            for row in batch.column(0).to_pylist():
                for p, part in enumerate(row):
                    distinct, place = _of_block(part, width, kind)
                    weight = np.bincount(place, minlength=len(distinct))
                    nearest, _ = trie_nearest(distinct, books[p].astype(kind))
                    order = np.argsort(nearest, kind="stable")
                    starts = np.flatnonzero(np.diff(nearest[order], prepend=-1))
                    used = nearest[order][starts]
                    large = object if kind is object else np.int64  # a block holds 2^15 parts, their components 2^31 at most
                    weighted = distinct[order].astype(large) * weight[order].astype(large)[:, None]
                    counts[p][used] += np.add.reduceat(weight[order], starts)
                    sums[p][used] += np.add.reduceat(weighted, starts, axis=0).astype(object)
        rows = [(p, e, d, int(counts[p][e]), str(sums[p][e, d])) for p in range(len(books)) for e in np.flatnonzero(counts[p]).tolist() for d in range(width)]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "entry", "dim", "n", "total"])
    return run


def _coded(books: list[np.ndarray], kind: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = books[0].shape[1]
        for batch in batches:
            for i, row in enumerate(batch.column(2).to_pylist()):
                codes, errors = [], 0
                for p, part in enumerate(row):
                    distinct, place = _of_block(part, width, kind)
                    nearest, error = trie_nearest(distinct, books[p].astype(kind))
                    codes.append(nearest[place].astype(np.uint8))
                    errors = errors + error.astype(object if kind is object else np.int64)[place]
                code = np.stack(codes, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i].values, batch.column(1)[i].values, pa.array([c.tobytes() for c in code], pa.binary()),
                     pa.array(errors.tolist(), pa.int64())], ["id", "label", "code", "error"])
    return run


class VectorCodes:
    """``codes``: one row per vector: id, label, ``code`` (binary, one byte a part), ``error``. ``books``: the codebooks, one
    matrix (entry, component) a part."""

    def __init__(self, codes: DataFrame, books: list[np.ndarray]):
        self.codes, self.books = codes, books

    def digest(self) -> str:
        """Hex SHA-256 of all components by part, entry and place, as decimal numbers with commas between them."""
        return hashlib.sha256(",".join(str(c) for book in self.books for c in book.ravel().tolist()).encode()).hexdigest()

    def decode(self, codes: DataFrame, code_col: str = "code") -> DataFrame:
        """``codes`` with ``decoded``: the entries that a code stands for, one after the other."""
        books = F.array(*[F.array(*[F.array(*[F.lit(int(c)) for c in entry]) for entry in book]) for book in self.books])
        hexed, place = F.hex(code_col), F.sequence(F.lit(0), F.lit(len(self.books) - 1))
        byte = lambda p: F.conv(F.substr(hexed, 2 * p + 1, F.lit(2)), 16, 10).cast("int")
        return codes.withColumn("decoded", F.flatten(F.transform(place, lambda p: books[p][byte(p)])))


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, block: int = BLOCK) -> VectorCodes:
    """Codes of all vectors and the codebooks behind them.

    Components become floor(scale * component); each vector is cut into ``parts`` equal consecutive parts. A part's codebook starts
    as that part of the vectors with the smallest ids. A round gives every part the nearest entry by squared distance, ties to
    the lower entry, and moves each entry to floor(sum / count) of its parts by component; unused entries stay.

    A block of vectors is stored once as sorted distinct parts with weights: a trie to each position. Every round is one
    pass over the blocks that walks the tries and sends, for each entry in use, one count and sums to a small aggregate; no
    vector is shuffled. The driver holds the codebooks: entries x components, whatever the number of vectors.

    Rows whose vector is null, or holds a component that is null or not finite, are left out. Rows without an id count as
    the largest ids; rows that repeat one are vectors of their own, in order of their components where that matters for the
    first codebooks. Vectors of different lengths, or of one that ``parts`` doesn't divide, count as filled up with zeros at the end.
    Distances are exact in whole numbers of whatever size; an error that a long can't hold ends the job. Other columns are
    not read. An empty table, or one of empty vectors, gives codes of entry 0 for its rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has a byte for each part: 1 to 256 entries")
    rows = stored(whole_components(vectors, id_col, vector_col, label_col, scale), "code-vectors")
    dims, most = rows.agg(F.max(F.size("x")), F.max(F.array_max(F.transform("x", lambda c: F.abs(c))))).first()
    width = -(-(dims or 0) // parts)
    kind = exact_type(width, most or 0)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    start = _matrix(pa.array([r["x"] for r in first], pa.list_(pa.int64())), parts * width) if first else np.zeros((1, parts * width), np.int64)
    books = [start[:, p * width:(p + 1) * width].astype(object) for p in range(parts)]

    label_type = rows.schema["label"].dataType.simpleString()
    cut = "array<struct<distinct: binary, place: binary>>"
    blocks = stored(rows.mapInArrow(_tries(parts, width, block), f"ids array<long>, labels array<{label_type}>, parts {cut}"), "code-tries")
    for _ in range(rounds if width else 0):
        sent = blocks.select("parts").mapInArrow(_sums(books, kind), "part int, entry int, dim int, n long, total string")
        found = sent.groupBy("part", "entry", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        books = [b.copy() for b in books]
        for r in found.collect():  # a number for each component of each entry
            books[r["part"]][r["entry"], r["dim"]] = int(r["total"]) // r["n"]
    codes = stored(blocks.mapInArrow(_coded(books, kind), f"id long, label {label_type}, code binary, error long"), "codes")
    return VectorCodes(codes, books)


def code_report(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id``, ``code`` in hex, ``error``, ``label_error`` (over equal labels, nulls together), ``codebooks_sha256``."""
    found = compress_vectors(vectors, id_col, vector_col, label_col)
    # stored, so that the join starts from plain shuffles, which adaptive execution splits where a label is hot
    by_label = stored(found.codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"), "code-labels")
    joined = found.codes.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
                         F.lit(found.digest()).alias("codebooks_sha256"))
