"""Line dedup: sharded cuckoo filters in front of exact reference counts, with insertion and deletion of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from claimscope.llm.common import stored

#: Fixed by the contract: what is stripped from both ends of a line, and the code points a key has at least.
STRIPPED, LEAST = " \t\n\x0b\x0c\r", 10
#: Postings that a task holds before it hands them on, keys that a filter shard holds on average, fewest shards, and
#: partitions that the postings of a shard are dealt over, so that a line in every document is no task's alone.
BLOCK, SHARD_KEYS, LEAST_SHARDS, SALTS = 200_000, 200_000, 64, 8
SLOTS = 4
_LAST = (1 << 63) - 1


class CuckooFilter:
    """Approximate set of 64-bit keys: 16-bit fingerprints, four to a bucket, two buckets for each key.

    Never denies a key it holds; affirms another with odds of about 1 in 8,000. ``add`` and ``remove`` take arrays; each
    key added takes a slot, so two keys of one fingerprint can be removed one by one.
    """

    def __init__(self, buckets: int, slots: np.ndarray | None = None):
        self.mask = np.uint64(buckets - 1)
        self.slots = np.zeros((buckets, SLOTS), np.uint16) if slots is None else slots

    @classmethod
    def holding(cls, keys: np.ndarray) -> CuckooFilter:
        keys, buckets = np.asarray(keys), 4
        while buckets * SLOTS * 0.85 < len(keys):
            buckets *= 2
        while True:
            made = cls(buckets)
            if made.add(keys):
                return made
            buckets *= 2

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = keys.astype(np.uint64)
        mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        marks = np.maximum(mixed >> np.uint64(48), np.uint64(1))
        return marks.astype(np.uint16), ((mixed >> np.uint64(8)) & self.mask).astype(np.int64)

    def _other(self, marks: np.ndarray, places: np.ndarray) -> np.ndarray:
        return places ^ ((marks.astype(np.uint64) * np.uint64(0x5BD1E9955BD1E995) >> np.uint64(20)) & self.mask).astype(np.int64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        marks, places = self._places(keys)
        other = self._other(marks, places)
        return (self.slots[places] == marks[:, None]).any(1) | (self.slots[other] == marks[:, None]).any(1)

    def add(self, keys: np.ndarray, rounds: int = 500) -> bool:
        """All keys at once, round by round: at most one to a bucket and round, and a full bucket passes one on."""
        marks, places = self._places(keys)
        dice = np.random.default_rng(len(keys))
        for turn in range(rounds):
            if not len(marks):
                return True
            chosen = np.unique(places, return_index=True)[1]
            rest = np.ones(len(marks), bool)
            rest[chosen] = False
            m, p = marks[chosen], places[chosen]
            empty = self.slots[p] == 0
            free = empty.any(1)
            self.slots[p[free], empty[free].argmax(1)] = m[free]
            m, p = m[~free], p[~free]
            if turn > 2 and len(m):  # every slot taken: one of those held moves to its other bucket
                which = dice.integers(0, SLOTS, len(m))
                held = self.slots[p, which].copy()
                self.slots[p, which] = m
                m = held
            marks, places = np.concatenate([marks[rest], m]), np.concatenate([places[rest], self._other(m, p)])
        return not len(marks)

    def remove(self, keys: np.ndarray) -> None:
        marks, places = self._places(keys)
        for m, a, b in zip(marks, places, self._other(marks, places), strict=True):
            for p in (a, b):
                at = np.flatnonzero(self.slots[p] == m)
                if len(at):
                    self.slots[p, at[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        slots = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(slots), slots)


def line_key(line: str) -> tuple[int, int] | None:
    """Both halves of the key's 128-bit hash; None for a line whose key is too short to count."""
    key = line.strip(STRIPPED)
    if len(key) < LEAST:
        return None
    high, low = divmod(xxhash.xxh3_128_intdigest(key.encode().lower()), 1 << 64)  # of bytes, lower() changes A-Z only
    return high - (1 << 63), low - (1 << 63)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k1, k2, doc, row) of arrays: the postings that a task has met, a bounded number to a row."""
    names = ["k1", "k2", "doc", "row"]
    held: list[tuple[int, int, int, int]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        ends = pa.array([0, len(held)], pa.int32())
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())) for x in zip(*held, strict=True)], names)
        held.clear()

    for batch in batches:
        for doc, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            text = text.as_py()
            if not text:
                continue
            held += [(*key, doc, row) for key in {line_key(x) for x in text.split("\n")} - {None}]
            if len(held) >= BLOCK:
                yield from flush()
    if held:
        yield from flush()


def _filters_of(keys: DataFrame, shards: int) -> DataFrame:
    """shard, ``filter`` of its distinct keys (k1, k2)."""
    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [key[0]], "filter": [CuckooFilter.holding(rows["k1"].to_numpy()).to_bytes()]})

    return keys.select("k1", F.pmod("k1", F.lit(shards)).alias("shard")).groupBy("shard").applyInPandas(build, "shard long, filter binary")


def _sifted(blocks: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """at, k1, k2, doc, row of the postings in ``blocks`` that the filter of their shard affirms.

    Blocks are cut by shard, and each part goes where a copy of its filter goes, behind it: a task holds one filter and
    one Arrow batch. The parts of a shard are dealt over ``SALTS`` partitions.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                at = batch.column(0)[n].as_py()
                cols = [batch.column(i)[n].values.to_numpy() for i in range(1, 5)]
                shard = cols[0] & (shards - 1)
                order = np.argsort(shard, kind="stable")
                shard = shard[order]
                starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
                ends = pa.array(np.r_[starts, len(shard)], pa.int32())
                salt = (cols[2][order][starts] ^ cols[3][order][starts]) % SALTS  # of the part's first document
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[starts]), pa.array(salt), pa.array([at] * len(starts), pa.int32())] + [
                        pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in cols], ["shard", "salt", "at", "k1", "k2", "doc", "row"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, None
        for batch in batches:
            for n in range(batch.num_rows):
                data = batch.column(7)[n]
                shard = batch.column(0)[n].as_py()
                if data.is_valid:
                    here, held = shard, CuckooFilter.from_bytes(data.as_py())
                elif shard == here:
                    cols = [batch.column(i)[n].values.to_numpy() for i in range(3, 7)]
                    found = np.flatnonzero(held.has(cols[0]))
                    if len(found):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([batch.column(2)[n].as_py()] * len(found), pa.int32())] + [pa.array(x[found]) for x in cols],
                            ["at", "k1", "k2", "doc", "row"])

    lists = ", ".join(f"{c} array<long>" for c in ("k1", "k2", "doc", "row"))
    parts = blocks.select("at", "k1", "k2", "doc", "row").mapInArrow(cut, f"shard long, salt long, at int, {lists}")
    copies = filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("salt", F.col("salt").cast("long"))
    both = parts.unionByName(copies, allowMissingColumns=True).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("filter").isNull())
    return both.mapInArrow(probe, "at int, k1 long, k2 long, doc long, row long")


def _identity(id_col: str):
    """Documents without an id count as one document, after all others."""
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LAST))


def _counted(postings: DataFrame) -> DataFrame:
    """k1, k2, ``refs`` (documents that hold the key), ``keeper`` (the smallest of them). Pairs are made distinct
    first and counted then, both combined before their shuffle, so a key in every document meets no single task."""
    return postings.select("k1", "k2", "doc").distinct().groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("refs"), F.min("doc").alias("keeper"))


class LineIndex:
    """Which lines are held by which documents, and which of them are shared, as tables that changes add to.

    * ``blocks``: the exact postings (key, document, hash of the row's text) of each insertion, numbered ``at``;
    * ``removed``: documents deleted, with the number of the deletion: postings of lower numbers no longer count;
    * the reference counts of shared keys, a base and, for each change, the keys whose count or keeper it moved;
    * a cuckoo filter of the shared keys of each shard, of which a change writes those shards whose keys came or went.

    ``insert`` and ``delete`` return a new index and leave the old one usable. Both read the postings once, past filters of
    the keys they touch; only postings of touched keys are shuffled and counted, and what is written follows the change.
    A key whose count goes from 1 to 2 is added to its filter, one that goes from 2 to 1 is removed. ``fold`` writes one base.
    """

    def __init__(self, blocks: DataFrame, removed: DataFrame | None = None, at: int = 0, counts: DataFrame | None = None,
                 changes: DataFrame | None = None, filters: DataFrame | None = None, shards: int = 0):
        self.blocks, self.removed, self.at = blocks, removed, at
        self.changes, self._counts, self._filters, self._n_shards = changes, counts, filters, shards

    @classmethod
    def of(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", at: int = 0) -> LineIndex:
        text = F.col(f"`{text_col}`")
        rows = docs.select(_identity(id_col).alias("doc"), F.xxhash64(text).alias("row"), text.alias("text"))
        found = rows.mapInArrow(_blocks, "k1 array<long>, k2 array<long>, doc array<long>, row array<long>")
        return cls(stored(found.withColumn("at", F.lit(at)), "line-blocks"), at=at)

    def _live(self, postings: DataFrame) -> DataFrame:
        if self.removed is None:
            return postings
        last = self.removed.groupBy("doc").agg(F.max("at").alias("_gone"))
        return postings.join(last, "doc", "left").where("_gone IS NULL OR _gone < at").drop("_gone")

    def postings(self) -> DataFrame:
        return self._live(self.blocks.select("at", F.inline(F.arrays_zip("k1", "k2", "doc", "row"))))

    def reference_counts(self) -> DataFrame:
        """The counts of all keys, from the postings."""
        return _counted(self.postings())

    def shared(self) -> DataFrame:
        """k1, k2, refs, keeper of the keys that several documents hold: the base under the last change of each key."""
        if self._counts is None:
            self._counts = stored(self.reference_counts().where("refs > 1"), "line-shared")
        if self.changes is None:
            return self._counts
        last = self.changes.join(self.changes.groupBy("k1", "k2").agg(F.max("at").alias("at")), ["k1", "k2", "at"])
        return self._counts.join(last, ["k1", "k2"], "left_anti").unionByName(last.where("refs > 1").select("k1", "k2", "refs", "keeper"))

    def shards(self) -> int:
        """Number of filter shards, a power of two that follows the shared keys of the base."""
        if not self._n_shards:
            self._n_shards, n = LEAST_SHARDS, self.shared().count()
            while self._n_shards * SHARD_KEYS < n:
                self._n_shards *= 2
        return self._n_shards

    def filters(self) -> DataFrame:
        """shard, ``filter`` of its shared keys."""
        if self._filters is None:
            self._filters = stored(_filters_of(self.shared(), self.shards()), "line-filters")
        return self._filters

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """The index with ``docs`` too. Lines of an id that it holds already are added to that document's."""
        added = LineIndex.of(docs, id_col, text_col, self.at + 1)
        return self._changed(self.blocks.unionByName(added.blocks), self.removed, added.postings().select("k1", "k2").distinct())

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
        """The index without the documents named; lines they kept go to the next holder. Ids it doesn't hold change nothing."""
        gone = stored(ids.select(_identity(id_col).alias("doc")).distinct().withColumn("at", F.lit(self.at + 1)), "line-removed")
        removed = gone if self.removed is None else self.removed.unionByName(gone)
        held = self.postings().join(gone.select("doc"), "doc", "left_semi").select("k1", "k2").distinct()
        return self._changed(self.blocks, removed, held.join(self.shared(), ["k1", "k2"], "left_semi"))

    def _changed(self, blocks: DataFrame, removed: DataFrame | None, touched: DataFrame) -> LineIndex:
        shards, at, both = self.shards(), self.at + 1, ["k1", "k2"]
        old, touched = self.filters(), stored(touched, "line-touched")
        after = LineIndex(blocks, removed, at, self._counts, shards=shards)
        now = _counted(after._live(_sifted(blocks, _filters_of(touched, shards), shards)).join(touched, both, "left_semi"))
        was = self.shared().join(touched, both, "left_semi").select(*both, F.col("refs").alias("_refs"), F.col("keeper").alias("_keeper"))
        moved = now.join(was, both, "full").withColumn("refs", F.coalesce("refs", F.lit(0)))
        moved = moved.where("(refs > 1 OR _refs IS NOT NULL) AND NOT (refs <=> _refs AND keeper <=> _keeper)")
        moved = stored(moved.select(*both, "refs", "keeper", F.col("_refs").isNotNull().alias("was"), F.lit(at).alias("at")), "line-changes")
        after.changes = moved if self.changes is None else self.changes.unionByName(moved)

        def turn(key: tuple, keys: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
            k1, come = keys["k1"].to_numpy(), keys["come"].to_numpy(bool)
            if len(known):
                held = CuckooFilter.from_bytes(known["filter"].iloc[0])
                held.remove(k1[~come])
                whole = held.add(k1[come])
            else:
                held, whole = CuckooFilter.holding(k1[come]), True
            return pd.DataFrame({"shard": [key[0]], "filter": [held.to_bytes() if whole else None]})

        turned = moved.where("(refs > 1) <> was").select("k1", (F.col("refs") > 1).alias("come"), F.pmod("k1", F.lit(shards)).alias("shard"))
        met = old.join(turned.select("shard").distinct(), "shard", "left_semi")
        fresh = stored(turned.groupBy("shard").cogroup(met.groupBy("shard")).applyInPandas(turn, "shard long, filter binary"), "line-filters")
        full = fresh.where("filter IS NULL").select("shard")  # no room left: these are built from their keys
        if not full.isEmpty():
            keys = after.shared().join(full, F.pmod("k1", F.lit(shards)) == F.col("shard"), "left_semi")
            fresh = fresh.where("filter IS NOT NULL").unionByName(stored(_filters_of(keys, shards), "line-filters"))
        after._filters = old.join(fresh.select("shard"), "shard", "left_anti").unionByName(fresh)
        return after

    def fold(self) -> LineIndex:
        """The same index as one base: postings of deleted documents go, and shards follow the keys anew."""
        postings = stored(self.postings().select("k1", "k2", "doc", "row").distinct(), "line-postings")
        parts = 1 + postings.count() // BLOCK
        packed = postings.groupBy(F.pmod(F.xxhash64("doc", "row", "k1"), F.lit(parts))).agg(
            *[F.collect_list(c).alias(c) for c in ("k1", "k2", "doc", "row")]).select("k1", "k2", "doc", "row")
        counts = stored(self.shared(), "line-shared")
        return LineIndex(stored(packed.withColumn("at", F.lit(self.at)), "line-blocks"), at=self.at, counts=counts)

    def surplus(self) -> DataFrame:
        """doc, row (hash of the text), k1, k2 of every line key that its document has to give up."""
        hits = self._live(_sifted(self.blocks, self.filters(), self.shards()))
        return hits.join(self.shared().select("k1", "k2", "keeper"), ["k1", "k2"]).where("doc <> keeper").select("doc", "row", "k1", "k2")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text`` reduced to the lines that stay, and ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of white space at both ends with A-Z in lower case. Keys of at least 10 code
    points that several documents hold stay in the smallest id only, there with all their lines. Null and empty texts
    are one empty line. Rows without an id count as one document, last in order; rows that repeat an id are one
    document too; lists of lines to drop are kept by row, so no array holds those of several rows. Long texts are read
    whole, one at a time. An empty table gives an empty result. Columns ``n_lines`` and ``n_dropped`` of the input are replaced; any other column is handed through.
    """
    surplus = LineIndex.of(docs, id_col, text_col).surplus()
    gone = surplus.groupBy("doc", "row").agg(F.collect_set("k1").alias("_gone"))
    kept = docs.drop("n_lines", "n_dropped")
    names = kept.columns
    at = names.index(text_col)
    rows = kept.toDF(*[f"c{i}" for i in range(len(names))])  # no name of the input can meet one of the join
    rows = rows.withColumn("_key", _identity(f"c{names.index(id_col)}")).withColumn("_row", F.xxhash64(f"c{at}"))
    rows = rows.join(gone, (F.col("_key") == F.col("doc")) & (F.col("_row") == F.col("row")), "left").drop("_key", "_row", "doc", "row")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, dropped = [], [], []
            for text, gone in zip(batch.column(at), batch.column(len(names)), strict=True):
                text = text.as_py() or ""
                n = text.count("\n") + 1
                d = 0
                if gone.is_valid:
                    out, left = set(gone.as_py()), []
                    for line in text.split("\n"):
                        key = line_key(line)
                        if key is not None and key[0] in out:
                            d += 1
                        else:
                            left.append(line)
                    text = "\n".join(left)
                texts.append(text)
                lines.append(n)
                dropped.append(d)
            cols = [*batch.columns[:-1], pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, [*names, "n_lines", "n_dropped"])

    schema = StructType([StructField(f.name, f.dataType, True) for f in kept.schema.fields] + [
                         StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    return rows.mapInArrow(keep, schema)
