"""The trie of conversation prefixes, with subtree totals by time-forward processing.

Nodes are the distinct sequences of first turns. A run of nodes with the same members is one chain: it is told by its smallest
member and their number, and all but its last node have one child. Chains, of which there are fewer than twice the distinct
conversations, are dealt in depth-first order over shards. A shard reads its chains in reverse level order and hands each
one's totals on to its parent through a priority queue that spills; what goes to a parent in an earlier shard is passed on across
the shards the same way, and added to that parent and all above it.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import posixpath
import struct
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from claimscope.llm.common import running_totals, stored
from claimscope.llm.token_files import open_store
from claimscope.session import fresh_dir

#: Messages that a priority queue holds in memory, and ids in a piece of text that is hashed.
IN_MEMORY, PIECE = 100_000, 1 << 14
#: Fixed by the contract: conversations share the first turns of the one whose id is the next lower multiple of this.
GROUP, LEADS = 100, 6
NOBODY = hashlib.sha256(b"").hexdigest()
_STEP = 16  # characters of a path for each chain


def turn_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id``, ``place`` (from 0), ``turns`` (of the conversation), ``digest`` (of role and text), ``chars`` of every turn.

    Turns are ordered by number, null first; those that share one by the MD5 of role and text. Null roles and texts are
    empty. Rows without a conversation id are left out. A conversation of any length is spread over ranges.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"), F.char_length(text).cast("long").alias("chars"))
    placed = running_totals(rows.where("conv_id IS NOT NULL"), ["conv_id", "turn", "digest"], {"place": F.lit(1)}, "trie-turns", within=["conv_id"])
    placed = stored(placed, "trie-places")
    counts = stored(placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns")), "trie-lengths")
    return placed.join(counts, "conv_id").select("conv_id", "place", "turns", "digest", "chars")


def rebuild(rows: DataFrame, group: int = GROUP, leads: int = LEADS) -> tuple[DataFrame, DataFrame]:
    """Rows of rebuilt conversations, and ``conv_id``, ``turns`` of all, those left without a turn included.

    Each conversation c gets the first h turns of conversation c - c % ``group`` (all it has, none if there is none) in place of its
    own first h, h being the CRC-32 of its decimal id modulo ``leads``.
    """
    lengths = rows.where("place = 0").select("conv_id", "turns")
    first = F.col("conv_id") - F.col("conv_id") % group
    h = F.when(first != F.col("conv_id"), F.crc32(F.col("conv_id").cast("string").cast("binary")) % leads).otherwise(F.lit(0))
    plan = lengths.select("conv_id", F.col("turns").alias("own"), first.alias("first"), h.alias("h"))
    given = lengths.select(F.col("conv_id").alias("first"), F.col("turns").alias("_has"))
    lead = F.least("h", F.coalesce("_has", F.lit(0)))
    plan = plan.join(given, "first", "left").select("conv_id", "first", "h", lead.alias("lead"), (lead + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("total"))
    plan = stored(plan, "trie-plan")
    turn = rows.select("conv_id", "place", "digest", "chars")
    own = turn.join(plan, "conv_id").where("place >= h").withColumn("place", F.col("place") - F.col("h") + F.col("lead"))
    led = turn.where(F.col("place") < leads - 1).withColumnRenamed("conv_id", "first").join(plan, "first").where("place < lead")
    columns = ["conv_id", "place", F.col("total").alias("turns"), "digest", "chars"]
    return own.select(columns).unionByName(led.select(columns)), plan.select("conv_id", F.col("total").alias("turns"))


class SpillingQueue:
    """A priority queue of (key, numbers) that keeps ``limit`` entries in memory and writes the rest, in sorted runs, to ``folder``,
    which all executors share. Entries with one key are added up when they are taken."""

    def __init__(self, folder: str, limit: int = IN_MEMORY):
        self.folder, self.limit = folder, limit
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []
        self.runs: list[Iterator[tuple]] = []
        self.files: list[tuple] = []
        self.spilled = 0

    def push(self, key: tuple, numbers: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, (key, numbers))
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        store, root = open_store(self.folder)
        store.create_dir(root, recursive=True)
        path = posixpath.join(root, f"run-{uuid.uuid4().hex}")
        entries = sorted(self.heap)
        with store.open_output_stream(path, compression=None) as out:
            for at in range(0, len(entries), 4096):
                part = pickle.dumps(entries[at:at + 4096])
                out.write(struct.pack("<I", len(part)) + part)
        self.files.append((store, path))
        self.runs.append(self._run(store, path))
        self.heap = []
        self.spilled += 1
        self._next(len(self.runs) - 1)

    @staticmethod
    def _run(store, path: str) -> Iterator[tuple]:
        with store.open_input_stream(path, compression=None) as source:
            while head := source.read(4):
                yield from pickle.loads(source.read(struct.unpack("<I", head)[0]))

    def _next(self, run: int) -> None:
        entry = next(self.runs[run], None)
        if entry is not None:
            heapq.heappush(self.heads, (*entry, run))

    def least(self) -> tuple | None:
        tops = [side[0][0] for side in (self.heap, self.heads) if side]
        return min(tops) if tops else None

    def take(self) -> tuple[tuple, tuple[int, ...]]:
        """The least key and the sums of all its entries."""
        key, sums = self.least(), (0, 0, 0)
        while self.least() == key:
            if self.heap and self.heap[0][0] == key:
                numbers = heapq.heappop(self.heap)[1]
            else:
                _, numbers, run = heapq.heappop(self.heads)
                self._next(run)
            sums = tuple(a + b for a, b in zip(sums, numbers, strict=True))
        return key, sums

    def close(self) -> None:
        for run in self.runs:
            run.close()
        for store, path in self.files:
            store.delete_file(path)


_TOTALS = "path string, outside boolean, kids long, leaves long, saved long"


def _batches(rows: Iterator[tuple], size: int = 8192) -> Iterator[pa.RecordBatch]:
    kinds, names = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()], ["path", "outside", "kids", "leaves", "saved"]
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)


def _key(path: str) -> tuple[int, str]:
    return -len(path), path


def within_shard(nodes: Iterator[tuple], queue: SpillingQueue) -> Iterator[tuple]:
    """``nodes``: (path, kids, leaves, saved) in reverse level order. Totals of each over what lies below it in this shard, and,
    marked as outside, what goes to parents that are not in it."""
    for path, kids, leaves, saved in nodes:
        key = _key(path)
        while (top := queue.least()) is not None and top < key:
            (_, parent), sums = queue.take()
            yield parent, True, *sums
        if top == key:
            below = queue.take()[1]
            kids, leaves, saved = kids + below[0], leaves + below[1], saved + below[2]
        yield path, False, kids, leaves, saved
        if len(path) > _STEP:
            queue.push(_key(path[:-_STEP]), (1, leaves, saved))
    while queue.least() is not None:
        (_, parent), sums = queue.take()
        yield parent, True, *sums


def across_shards(sent: Iterator[tuple], queue: SpillingQueue) -> Iterator[tuple]:
    """``sent``: (path, kids, leaves, saved) in reverse level order, what reaches a node from other shards. What it adds to that
    node and to every node above: the number of children to the node alone."""
    def settle(key: tuple, kids: int, leaves: int, saved: int) -> tuple:
        if len(key[1]) > _STEP:
            queue.push(_key(key[1][:-_STEP]), (0, leaves, saved))
        return key[1], True, kids, leaves, saved

    for path, kids, leaves, saved in sent:
        key = _key(path)
        while (top := queue.least()) is not None and top < key:
            other, sums = queue.take()
            yield settle(other, *sums)
        below = queue.take()[1] if top == key else (0, 0, 0)
        yield settle(key, kids + below[0], leaves + below[1], saved + below[2])
    while queue.least() is not None:
        key, sums = queue.take()
        yield settle(key, *sums)


def _passed(walk: Callable, folder: str, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(folder, limit)
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        try:
            yield from _batches(walk(rows, queue))
        finally:
            queue.close()
    return run


def subtree_totals(chains: DataFrame, limit: int = IN_MEMORY) -> DataFrame:
    """``path``, ``kids``, ``leaves``, ``saved``: sums over the subtree of each chain of ``chains`` (path, leaves, saved); kids are its children.

    Depth-first order puts what lies below a chain next to it, so what leaves a shard goes to chains above the shard's first
    one: one row for each of those. They are added up before they meet in one task, which holds rows of that kind only.
    """
    folder = fresh_dir(chains.sparkSession, "trie-spill")
    level = F.length("path").desc()
    nodes = chains.select("path", F.lit(0).cast("long").alias("kids"), "leaves", "saved")
    shards = nodes.repartitionByRange("path").sortWithinPartitions(level, "path")
    inside = stored(shards.mapInArrow(_passed(within_shard, folder, limit), _TOTALS), "trie-shards")
    sums = [F.sum(c).alias(c) for c in ("kids", "leaves", "saved")]
    sent = inside.where("outside").groupBy("path").agg(*sums).coalesce(1).sortWithinPartitions(level, "path")
    added = stored(sent.mapInArrow(_passed(across_shards, folder, limit), _TOTALS), "trie-roots")
    extra = added.select("path", *[F.col(c).alias(f"_{c}") for c in ("kids", "leaves", "saved")])
    return inside.where("NOT outside").join(extra, "path", "left").select(
        "path", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in ("kids", "leaves", "saved")])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order, as pieces of text; a piece ends with its node, or when it holds ``PIECE`` ids."""
    place, n = TaskContext.get().partitionId(), 0
    key, held, out = None, [], []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["rep", "n_convs", "place", "piece", "ids"])

    for rows in batches:
        for rep, size, conv in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if held and (key != (rep, size) or len(held) == PIECE):
                out.append((*key, place, n, ",".join(held)))
                held, n = [], n + 1
                if len(out) == 1024:
                    yield batch()
                    out = []
            key = (rep, size)
            held.append(str(conv))
    if held:
        out.append((*key, place, n, ",".join(held)))
    if out:
        yield batch()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of all pieces of a node, one after the other, in a task that holds one piece."""
    key, state, out = None, None, []
    names = ["rep", "n_convs", "ends_sha256"]

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.string()], strict=True)], names)

    for rows in batches:
        for rep, size, ids in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if key != (rep, size):
                if key:
                    out.append((*key, state.hexdigest()))
                    if len(out) == 8192:
                        yield batch()
                        out = []
                key, state = (rep, size), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if key:
        out.append((*key, state.hexdigest()))
    if out:
        yield batch()


def prefix_trie(rows: DataFrame, convs: DataFrame, limit: int = IN_MEMORY) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``, for the conversations of ``convs`` (``conv_id``, ``turns``) and their turns in ``rows`` (see ``turn_rows``).

    1. A prefix is told by its depth and 128 bits: sums, over its turns, of hashes of place and digest. They are running
       totals over ranges of turns, so one conversation may hold any share of all rows.
    2. Nodes, then chains, are partial aggregates: a prefix that many share combines before the shuffle.
    3. A chain's path lists the smallest members of the chains from the root to it. A conversation with k chains on its way has
       members in numbers that fall k times, so there are k * k / 2 rows at least and the list of k entries stays small.
    4. Totals of the chains: see ``subtree_totals``. Those of a node follow from its chain and the characters before it.
    5. Ids of those that end at a node are sorted over ranges, joined to pieces, and the pieces hashed in order.

    Turnless conversations end at the root. Conversations with equal turns are members, and ends, of the same nodes. Texts of any
    length count by their digest and length. No conversations give no rows. Columns beside those named are not read.
    """
    first, second = F.xxhash64(F.lit(11), "place", "digest"), F.xxhash64(F.lit(13), "place", "digest")
    low = lambda c: c.bitwiseAND(F.lit(0xFFFFFFFF))
    marked = rows.select("conv_id", "place", "turns", "chars", low(first).alias("h0"), F.shiftrightunsigned(first, 32).alias("h1"),
                         low(second).alias("h2"), F.shiftrightunsigned(second, 32).alias("h3"))
    sums = {f"s{i}": F.col(f"h{i}") for i in range(4)} | {"before": F.col("chars")}
    summed = running_totals(marked, ["conv_id", "place"], sums, "trie-prefixes", within=["conv_id"])
    node = F.unhex(F.md5(F.concat_ws(":", (F.col("place") + 1).cast("string"), *[(F.col(f"s{i}") + F.col(f"h{i}")).cast("string") for i in range(4)])))
    depth = F.col("place") + 1
    steps = stored(summed.select("conv_id", depth.alias("depth"), (depth == F.col("turns")).alias("last"), "chars", "before", node.alias("node")), "trie-steps")

    root = F.unhex(F.lit("00" * 16))
    top = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("rep"), F.count(F.when(F.col("turns") == 0, 1)).alias("ends"))
    zero = F.lit(0).cast("long")
    top = top.where("n_convs > 0").select(root.alias("node"), "n_convs", "rep", "ends", zero.alias("depth"), zero.alias("before"), zero.alias("chars"))
    nodes = steps.groupBy("node").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("rep"), F.count(F.when(F.col("last"), 1)).alias("ends"),
        F.min("depth").alias("depth"), F.min("before").alias("before"), F.min("chars").alias("chars"))
    nodes = stored(nodes.unionByName(top), "trie-nodes")
    chains = nodes.groupBy("rep", "n_convs").agg(
        F.min("depth").alias("head"), F.max("depth").alias("bottom"), F.min("before").alias("head_before"),
        F.max(F.col("before") + F.col("chars")).alias("reach"), F.max("ends").alias("ends"))
    chains = stored(chains.withColumn("saved", (F.col("n_convs") - 1) * (F.col("reach") - F.col("head_before"))), "trie-chains")

    ways = steps.select("conv_id", "node").join(chains.select(F.col("rep").alias("conv_id")).distinct(), "conv_id", "left_semi")
    met = ways.join(nodes.select("node", "rep", "n_convs"), "node").select("conv_id", "rep", "n_convs")
    over = top.select("rep", "n_convs").hint("broadcast")  # one row
    met = met.unionByName(chains.select(F.col("rep").alias("conv_id")).distinct().join(over).select("conv_id", "rep", "n_convs"))
    way = met.groupBy("conv_id").agg(F.sort_array(F.collect_set(F.struct((-F.col("n_convs")).alias("n"), "rep"))).alias("way"))
    name = lambda c: F.lpad(F.hex(c["rep"]), _STEP, "0")
    placed = way.select("conv_id", "way", F.posexplode("way").alias("at", "chain")).where(F.col("chain.rep") == F.col("conv_id")).select(
        F.col("conv_id").alias("rep"), (-F.col("chain.n")).alias("n_convs"),
        F.array_join(F.transform(F.slice("way", 1, F.col("at") + 1), name), "").alias("path"),
        F.when(F.col("at") > 0, F.get("way", F.col("at") - 1)["rep"]).alias("above"))
    placed = stored(placed.join(chains, ["rep", "n_convs"]), "trie-paths")
    leaf = (F.col("ends") == F.col("n_convs")).cast("long")
    totals = subtree_totals(placed.select("path", leaf.alias("leaves"), "saved"), limit)

    ends = steps.where("last").select("conv_id", "node").unionByName(convs.where("turns = 0").select("conv_id", root.alias("node")))
    ended = ends.join(nodes.select("node", "rep", "n_convs"), "node").select("rep", "n_convs", "conv_id")
    order = ["rep", "n_convs", "conv_id"]
    pieces = ended.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces, "rep long, n_convs long, place int, piece long, ids string")
    hashed = pieces.repartition("rep", "n_convs").sortWithinPartitions("rep", "n_convs", "place", "piece").select("rep", "n_convs", "ids").mapInArrow(
        _hashed, "rep long, n_convs long, ends_sha256 string")

    chain = placed.select("path", "rep", "n_convs", "above", "head", "bottom", "head_before").join(totals, "path").join(hashed, ["rep", "n_convs"], "left")
    chain = stored(chain, "trie-totals")
    found = nodes.select("rep", "n_convs", "depth", "before").join(chain, ["rep", "n_convs"])
    at_bottom = F.col("depth") == F.col("bottom")
    return found.select(
        F.col("rep").alias("conv_id"), "depth", F.when(F.col("depth") > F.col("head"), F.col("rep")).otherwise(F.col("above")).alias("parent_conv_id"),
        "n_convs", F.when(at_bottom, F.col("kids")).otherwise(F.lit(1)).alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("saved") - (F.col("n_convs") - 1) * (F.col("before") - F.col("head_before"))).alias("saved_tokens"),
        F.when(at_bottom, F.coalesce("ends_sha256", F.lit(NOBODY))).otherwise(F.lit(NOBODY)).alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(*rebuild(turn_rows(conversations, conv_col, turn_col, role_col, text_col)))
