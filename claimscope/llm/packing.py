"""Best-fit packing with certificates: lower bounds say which partitions could do better; those exchange documents."""

from __future__ import annotations

import json
import re
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimscope.llm.common import stored

CAPACITY = 2048
#: Pieces that one packing task holds on average.
GROUP = 8192
#: Fixed by the tokenizer: how byte-level BPE splits a text before it merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level BPE files write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class BpeEncoder:
    """Ids of a byte-level BPE file as little-endian 32-bit bytes. An added token of the file that a text holds becomes
    its own id, and the texts on either side of it are encoded each for itself.

    Between two spaces of a text nothing merges across, so the ids of a text are those of its space-led chunks, of
    which a bounded number is remembered. Texts with other white space than single spaces and newlines between
    words go through the encoder whole.
    """

    #: White space that sends a text through the encoder whole, and a mark that chunks are split at.
    ODD = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"] + ["\0", "  ", " \n", "\n ", "\n\n"]

    def __init__(self, path: str, remember: int = 300_000):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model, added = whole["model"], whole.get("added_tokens") or []
        if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in added):
            raise ValueError(f"{path}: added tokens that look at what is around them")
        special = byte_symbols()
        ranks = {}
        for word, i in model["vocab"].items():
            if all(c in special for c in word):
                ranks[bytes(special[c] for c in word)] = i
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"][a + b] for a, b in merges]
        if ids != sorted(ids):
            raise ValueError(f"{path}: merges are not in the order of their ids")
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        self.at_added = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")")
        for token in self.added:
            ranks.pop(token.encode(), None)
        self.encoder = tiktoken.Encoding("bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.remember, self.known = remember, {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.encoder.encode_ordinary(text), "<u4").tobytes()

    def _chunks(self, chunks: list[str]) -> bytes:
        known = self.known
        try:
            return b"".join([known[c] for c in chunks])
        except KeyError:
            pass
        if len(known) > self.remember:
            known.clear()
        for c in chunks:
            if c not in known:
                known[c] = self._ids(c)
        return b"".join([known[c] for c in chunks])

    def encode(self, text: str) -> bytes:
        if not any(token in text for token in self.added):
            return self._between(text)
        parts = self.at_added.split(text)
        return b"".join(self.added[part] if n % 2 else self._between(part) for n, part in enumerate(parts))

    def _between(self, text: str) -> bytes:
        if not text:
            return b""
        if text[0] in " \n" or text[-1] in " \n" or any(c in text for c in self.ODD):
            return self._ids(text)
        return self._chunks(text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0"))


def encoder(path: str) -> BpeEncoder:
    """One encoder for each file and process. It is kept with the interpreter: this function comes anew with each task."""
    known = sys.__dict__.setdefault("_bpe_encoders", {})
    if path not in known:
        known[path] = BpeEncoder(path)
    return known[path]


def piece_bounds(tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of each piece: whole capacities at the end, what is over first."""
    first = tokens % capacity
    bounds = [(0, first)] if first else []
    return bounds + [(s, capacity) for s in range(first, tokens, capacity)]


def _pieces(path: str, capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + b"\0\0\0\0"
                for k, (start, length) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    out.append((doc, k, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])
    return cut


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, and the number of bins. Longest first, each into the fullest bin it fits in."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, count = 0, 0  # bit r of rooms: some bin has exactly r left
    for i in order.tolist():
        n = int(lengths[i])
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            b, room, count = count, capacity, count + 1
        bins[i], offsets[i] = b, capacity - room
        left = room - n
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets, count


def bins_needed(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """A number of bins that no packing goes below; ``counts[n]`` is how many pieces have length n.

    Dual feasible functions give each length a weight such that no full bin weighs more than one: the length itself,
    lengths with small ones left out and the lengths that leave no room for others rounded up, and steps of 1 / k.
    """
    sizes = np.arange(capacity + 1)
    best = -(-int((counts * sizes).sum()) // capacity)
    low_sum, low = np.cumsum(counts * sizes), np.cumsum(counts)
    total = int(low[-1])
    for t in range(1, capacity // 2 + 1):
        big = total - int(low[capacity - t])
        mid = int(low_sum[capacity - t] - low_sum[t - 1])
        best = max(best, big + -(-mid // capacity))
    used = np.flatnonzero(counts)
    for t in range(1, capacity // 2 + 1):
        k = capacity // t
        weight = np.where(used * 2 > capacity, k - (capacity - used) // t, np.where(used >= t, 1, 0))
        best = max(best, -(-int((weight * counts[used]).sum()) // k))
    for k in range(2, 40):
        scaled = (k + 1) * used
        weight = np.where(scaled % capacity == 0, scaled * k, scaled // capacity * capacity * (k + 1))  # x itself, or floor((k+1)x)/k
        best = max(best, -(-int((weight * counts[used]).sum()) // (capacity * k * (k + 1))))
    return best


def _pack_round(pieces: DataFrame, rows: int, turn: int, capacity: int, group: int) -> DataFrame:
    """``pieces`` dealt anew over groups and packed in each: bin, offset, fill of the bin, and whether the group is certified."""
    groups = max(1, -(-rows // group))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy()
        bins, offsets, count = best_fit_decreasing(lengths, capacity)
        certain = count == bins_needed(np.bincount(lengths, minlength=capacity + 1), capacity)
        fill = np.bincount(bins, lengths).astype(np.int64)
        return rows.drop(columns="_group").assign(
            sequence_id=(turn << 58) + (int(key[0]) << 26) + bins, offset=offsets, fill=fill[bins], certain=certain)

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.lit(turn), "doc_id", "piece", "ids_crc32"), F.lit(groups)))
    packed = dealt.groupBy("_group").applyInPandas(
        pack, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, fill long, certain boolean")
    return stored(packed, "pack-round")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         group: int = GROUP) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    Texts become ids of the byte-level BPE file ``tokenizer``, and a 0 at the end. Pieces as long as a sequence stand
    alone. The others are dealt by hash over groups of about ``group`` pieces; each group packs by best-fit
    decreasing and compares its number of bins with a lower bound from dual feasible functions, which certifies it where
    the two are equal. While all groups together need more bins than the bound over all pieces, groups with a gap
    exchange the pieces of their bins that are not full: these are dealt anew among such groups and packed again. A
    round counts only if it saves bins. Once no group has a gap, or a round saves nothing, the open bins of certified
    groups come in too, as their rooms are all that is left to fill. The exchange ends when the bound over everything
    is met or a round over all open bins saves nothing; there is no limit on rounds.

    Null texts are empty and take one place. Null ids are kept as null. Rows that repeat an id are packed each for
    itself. Only the two columns named are read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    pieces = stored(rows.mapInArrow(_pieces(tokenizer, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    whole = pieces.where(F.col("length") == capacity)
    alone = whole.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))

    loose = pieces.where(F.col("length") < capacity)
    counts = np.zeros(capacity + 1, np.int64)
    for r in loose.groupBy("length").count().collect():  # one row for each length below the capacity
        counts[r["length"]] = r["count"]
    n, bound = int(counts.sum()), bins_needed(counts, capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    if not n:
        return alone.select(columns).withColumnRenamed("doc_id", id_col)

    def bins(df: DataFrame) -> tuple[int, int]:
        row = df.agg(F.count(F.when(F.col("offset") == 0, 1)), F.count(F.lit(1))).first()
        return row[0], row[1]

    packed = _pack_round(loose, n, 0, capacity, group)
    used, turn, gaps_only = bins(packed)[0], 0, True
    while used > bound and n > group:
        movable = F.col("fill") < capacity
        if gaps_only:
            movable &= ~F.col("certain")
        before, left = bins(packed.where(movable))
        saved = 0
        if left:
            turn += 1
            again = _pack_round(packed.where(movable).select(loose.columns), left, turn, capacity, group)
            saved = before - bins(again)[0]
            if saved > 0:
                packed, used = packed.where(~movable).unionByName(again), used - saved
        if saved <= 0:
            if not gaps_only:
                break
            gaps_only = False
    return packed.select(columns).unionByName(alone.select(columns)).withColumnRenamed("doc_id", id_col)
