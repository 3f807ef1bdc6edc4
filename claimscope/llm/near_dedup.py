"""Near dedup with SetSketch registers: band them for candidates, estimate jointly by likelihood, verify on full sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from claimscope.llm.common import components, stored

#: Registers in a sketch, in a band, and documents that a resolving task takes from each of its two blocks.
BANDS, BAND = 40, 6
REGISTERS = BANDS * BAND
BLOCK = 1024
#: Registers are exponentially spaced with this base; the rate places the first register below the smallest set.
BASE, RATE, TOP = 1.1, 20.0, 255
_LAST = (1 << 63) - 1
_dice = np.random.default_rng(20)
_MULTIPLIERS = _dice.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_MASKS = _dice.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_PLACES = _dice.integers(0, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``k``-word shingles; with fewer words, of the whole sequence; else empty.

    Words are runs of anything but space and the control characters 9 to 13, with A-Z in lower case: ``split`` and
    ``lower`` of bytes do just that.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(k, len(h))
    n = len(h) - width + 1
    total = np.full(n, width, np.uint64)
    for j in range(width):
        total = mixed(total + h[j:j + n] * _PLACES[j % 64])
    return np.unique(total)


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set that is not empty: floor(1 - log_b x), cut to a byte, of the smallest of the
    exponential values that its elements draw for each register. The maximum of two sketches is that of the union."""
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(folded), 1024):
        drawn = (folded[at:at + 1024, None] ^ _MASKS) * _MULTIPLIERS
        np.minimum(least, drawn.min(axis=0), out=least)
    x = -np.log1p(-(least.astype(np.float64) + 0.5) / 4294967296.0) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP).astype(np.uint8)


def _share(x: np.ndarray) -> np.ndarray:
    return -np.log(np.maximum(1 - x * (BASE - 1) / BASE, 1e-300)) / np.log(BASE)


def log_likelihood(more: np.ndarray, less: np.ndarray, u: np.ndarray, jaccard: np.ndarray) -> np.ndarray:
    """Of a Jaccard similarity, given in how many registers the first sketch is above and below the second, and the
    first set's share ``u`` of both sizes."""
    v = 1 - u
    j = np.minimum(jaccard, np.minimum(u / v, v / u))
    above, below = np.maximum(_share(u - v * j), 1e-12), np.maximum(_share(v - u * j), 1e-12)
    equal = np.maximum(1 - above - below, 1e-12)
    return more * np.log(above) + less * np.log(below) + (REGISTERS - more - less) * np.log(equal)


def may_reach(more: np.ndarray, less: np.ndarray, u: np.ndarray, similarity: float, slack: float = 14.0) -> np.ndarray:
    """Whether the joint likelihood of the registers leaves ``similarity`` or more possible: its best value there is
    within ``slack`` of the best anywhere (an error of about one in ten million)."""
    grid = np.linspace(0, 1, 51)
    values = np.stack([log_likelihood(more, less, u, np.full(len(u), j)) for j in grid])
    reached = np.stack([log_likelihood(more, less, u, np.full(len(u), j)) for j in [similarity, *grid[grid > similarity]]])
    return reached.max(axis=0) >= values.max(axis=0) - slack


def links(nodes: list[int], sets: list[np.ndarray], sides: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that span the components of the given sets. ``sides`` is 0 for all, or 0 and 1 where only pairs of two sides count.

    A pair that is connected already is not looked at again. Others pass by size, by equal registers, by joint
    likelihood, and last by the exact sizes of intersection and union.
    """
    n = len(nodes)
    sizes = np.array([len(s) for s in sets])
    sketches = np.stack([registers(s) for s in sets])
    group = np.unique(np.array(nodes), return_inverse=True)[1]
    both = len(np.unique(sides)) > 1
    share = percent / 100
    least_equal = REGISTERS * share - 7 * np.sqrt(REGISTERS * share * (1 - share))
    found = []
    for i in range(n - 1):
        rest = np.arange(i + 1, n)
        rest = rest[(group[rest] != group[i]) & (np.minimum(sizes[rest], sizes[i]) * 100 >= percent * np.maximum(sizes[rest], sizes[i]))]
        if both:
            rest = rest[sides[rest] != sides[i]]
        if not len(rest):
            continue
        more, less = (sketches[i] > sketches[rest]).sum(1), (sketches[i] < sketches[rest]).sum(1)
        near = REGISTERS - more - less >= least_equal
        rest, more, less = rest[near], more[near], less[near]
        if not len(rest):
            continue
        able = may_reach(more, less, sizes[i] / (sizes[i] + sizes[rest]), share)
        rest = rest[able][np.argsort(more[able] + less[able], kind="stable")]
        a = sets[i]
        for j in rest.tolist():
            if group[i] == group[j]:
                continue
            b = sets[j]
            short, long = (a, b) if len(a) <= len(b) else (b, a)
            at = np.searchsorted(long, short)
            at[at == len(long)] = 0
            common = int((long[at] == short).sum())
            if 100 * common >= percent * (len(a) + len(b) - common):
                found.append((nodes[i], nodes[j]))
                group[group == group[j]] = group[i]
    return found


def _sketched(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = shingle_set(text.as_py(), k)
                if len(s):
                    high, low = divmod(xxhash.xxh3_128_intdigest(s.tobytes()), 1 << 64)
                    out.append((doc, len(s), high - (1 << 63), low - (1 << 63), registers(s).tobytes()))
                else:
                    out.append((doc, 0, None, None, None))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["doc", "n", "s1", "s2", "sketch"])
    return run


def _resolved(k: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets, sides = None, [], [], []

        def solve() -> Iterator[pa.RecordBatch]:
            if len(nodes) > 1:
                found = np.array(links(nodes, sets, np.array(sides), percent), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

        for batch in batches:
            cols = batch.to_pydict()
            for comp, i, j, block, node, text in zip(*(cols[c] for c in ("comp", "i", "j", "block", "node", "text")), strict=True):
                if key != (comp, i, j):
                    yield from solve()
                    key, nodes, sets, sides = (comp, i, j), [], [], []
                nodes.append(node)
                sets.append(shingle_set(text, k))
                sides.append(int(block != i))
        yield from solve()
    return run


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80,
               block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` (smallest id reachable over links), ``kept``.

    Two documents are linked where 100 * |intersection| >= ``percent`` * |union| of their ``shingle``-word sets.

    1. Each text becomes 240 SetSketch registers. Documents with equal sets are one node, the smallest id.
    2. Registers are banded, six to a band, 40 bands; a pair at 0.8 shares no band with odds of 5 in a million, a pair
       at 0.3 shares one with odds of 3 %. Every member of a bucket is joined with the bucket's smallest node, which
       keeps their number linear, and connected components of those pairs are the candidate groups. Any link that a
       band brings to light lies inside a group.
    3. Groups are resolved a block, or a pair of blocks of a group, to a task: likelihood first, exact sets after. Only
       links that connect something new are looked for and handed on, so big groups of copies stay cheap.
    4. Components of the links are the result.

    Texts without words have an empty set, are linked with nothing and stay. Null texts count as such. Rows without an
    id share one, which comes after all others; it is shown as null. Each row follows its own text, so rows that repeat
    an id may differ in their component; two texts with the same smallest holder count as linked. Other columns are not
    read. An empty table gives an empty result.
    """
    texts = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LAST)).alias("doc"), F.col(f"`{text_col}`").alias("text"))
    rows = stored(texts.mapInArrow(_sketched(shingle), "doc long, n long, s1 long, s2 long, sketch binary"), "near-sketches")
    # stored, so that the joins with it start from plain shuffles, which adaptive execution splits where a set is hot
    equal = stored(rows.where("n > 0").groupBy("s1", "s2").agg(F.min("doc").alias("node")), "near-sets")
    mapped = stored(rows.select("doc", "n", "s1", "s2").join(equal, ["s1", "s2"], "left").select(
        "doc", "n", F.coalesce("node", "doc").alias("node")), "near-nodes")

    first = rows.where("n > 0").join(equal, ["s1", "s2"]).where("doc = node")
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("sketch", b * BAND + 1, BAND)) for b in range(BANDS)])
    banded = first.select("node", F.explode(keys).alias("key"))
    least = stored(banded.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("_most")).where("a <> _most").select("key", "a"), "near-buckets")
    pairs = banded.join(least.hint("merge"), "key").where("node <> a").select("a", F.col("node").alias("b"))
    grouped = stored(components(pairs).withColumnRenamed("component", "comp"), "near-groups")

    sizes = grouped.groupBy("comp").agg(F.count(F.lit(1)).alias("members"))
    parts = F.ceil(F.col("members") / block).cast("int")
    dealt = grouped.join(sizes.select("comp", parts.alias("parts")), "comp")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = dealt.select("comp", "node", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    tasks = dealt.select("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node")
    # dealt by id whatever the size of the groups, so that the plan, and what it moves, does not jump at some size
    work = texts.join(tasks.hint("merge"), texts["doc"] == tasks["node"]).select("comp", "i", "j", "block", "node", "text")
    spread = work.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", "node")
    found = stored(spread.mapInArrow(_resolved(shingle, percent), "a long, b long"), "near-links")

    linked = components(found)
    out = mapped.join(linked, "node", "left").withColumn("component", F.when(F.col("n") > 0, F.coalesce("component", "node")).otherwise(F.col("doc")))
    shown = [F.when(F.col(c) != _LAST, F.col(c)) for c in ("doc", "component")]
    return out.select(shown[0].alias(id_col), F.col("n").alias("n_shingles"), shown[1].alias("component_id"),
                      (F.col("doc") == F.col("component")).alias("kept"))
