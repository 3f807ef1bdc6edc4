"""Secret scans with corpus-wide ownership: how many owners and repositories share a candidate decides what it is."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from claimscope.llm.common import stored

# The kinds in their order, their patterns and least lengths.
KINDS = ["assign", "access", "hex", "token"]
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs of [0-9a-f]+ with 16 characters or more
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
# Candidates of the method itself: long opaque strings without a telling name.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
TOKEN_ENTROPY = 3.0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the base rules, by start, then kind. A match that is too short is dropped, and the
    search goes on behind it."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def opaque(value: str) -> bool:
    """Digits and letters mixed, and no more repetition than random strings have."""
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and entropy(value) >= TOKEN_ENTROPY


def token_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Opaque strings that no base span overlaps."""
    found = []
    for m in TOKEN.finditer(text):
        if opaque(m[0]) and not any(s < m.end() and m.start() < e for s, _, e, _ in base):
            found.append((m.start(), 3, m.end(), m[0]))
    return found


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, n = TaskContext.get().partitionId(), 0
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("hash", pa.string())]))
    for batch in batches:
        rows: list[tuple] = []
        for doc, owner, repo, text in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
            text = text.as_py() or ""
            base = base_spans(text)
            listed = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in base)
            counts = Counter(k for _, k, _, _ in base)
            spans = [{"start": s, "kind": k, "end": e, "hash": xxhash.xxh3_128_hexdigest(v.encode())}
                     for s, k, e, v in [*base, *token_spans(text, base)]]
            rows.append(((part << 40) + n, doc, owner, repo, counts[0], counts[1], counts[2], hashlib.sha256(listed.encode()).hexdigest(), spans))
            n += 1
        cols = list(zip(*rows, strict=True)) or [[]] * 9
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), span)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [
            "row", "doc_id", "owner", "repo", "n_assign", "n_access", "n_hex", "base_sha256", "found"])


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                repo_cols: tuple[str, ...] = ("source", "lang"), wide: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, counts and digest of the base spans, ``spans``, ``n_live``, ``n_shared``,
    ``n_copied``, ``n_repos``.

    Every candidate (a value that a base rule finds, or another long opaque string) is hashed, and the whole corpus
    says how many distinct repositories (``repo_cols`` together) and owners (``owner_col``) hold it. A value held by a
    single owner looks live, in however many of that owner's repositories it lies; one held by ``wide`` owners or more
    is a copied example; one between the two is shared. Opaque strings that look live become spans of kind ``token``
    beside the base spans, which stay whatever their class. ``n_live``, ``n_shared`` and ``n_copied`` count the
    document's candidates of each class; ``n_repos`` is the largest number of repositories that hold one of its live ones.

    Null texts are empty and have no spans. Long texts are scanned whole, one at a time. A null owner or repository is
    one of its own. Null ids are kept; rows that repeat an id are scanned each for itself and share an owner, so
    repeating a row makes nothing look copied. Other columns are not read. An empty table gives an empty result.
    """
    name = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in repo_cols]
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{owner_col}`").cast("string"), F.lit("\u0000")).alias("owner"),
                       F.concat_ws("\u0001", *name).alias("repo"), F.col(f"`{text_col}`").alias("text"))
    scanned = stored(rows.mapInArrow(
        _scanned, "row long, doc_id long, owner string, repo string, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "found array<struct<start: long, kind: int, end: long, hash: string>>"), "secret-scan")

    each = scanned.select("row", "owner", "repo", F.inline("found"))
    held = each.select("hash", "owner", "repo").distinct().groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    held = held.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"))
    live, copied = F.col("owners") == 1, F.col("owners") >= wide
    judged = each.join(held, "hash")
    shown = F.struct("start", "kind", "end")
    by_row = judged.groupBy("row").agg(
        F.collect_list(F.when((F.col("kind") < 3) | live, shown)).alias("shown"),
        F.count(F.when(live, 1)).alias("n_live"), F.count(F.when(~live & ~copied, 1)).alias("n_shared"),
        F.count(F.when(copied & ~live, 1)).alias("n_copied"), F.max(F.when(live, F.col("repos"))).alias("n_repos"))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(F.array_sort("shown"), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    out = scanned.drop("found").join(by_row.withColumn("spans", F.array_join(text, ",")), "row", "left")
    return out.select(F.col("doc_id").alias(id_col), "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce("spans", F.lit("")).alias("spans"),
                      *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_live", "n_shared", "n_copied", "n_repos")])
