"""Sharding along a Hilbert curve over several metadata dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import NumericType

from claimscope.llm.common import running_totals, stored


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Next state and output digit for each (state, cell digit), flattened; a state is (entry corner, direction).

    Along the curve, a cube's corners follow the Gray code; each corner's cube is entered and left at known corners,
    which gives the turn that its own corners must be read with.
    """
    n, full = dims, (1 << dims) - 1

    def turn(x: int, by: int) -> int:
        by %= n
        return ((x >> by) | (x << (n - by))) & full

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    place = {gray(i): i for i in range(1 << n)}

    def trailing(i: int) -> int:
        return (~i & (i + 1)).bit_length() - 1

    def entry(i: int) -> int:
        return 0 if i == 0 else gray(2 * ((i - 1) // 2))

    def way(i: int) -> int:
        return 0 if i == 0 else (trailing(i - 1) if i % 2 == 0 else trailing(i)) % n

    nexts, digits = [], []
    for state in range((1 << n) * n):
        corner, direction = divmod(state, n)
        for cell in range(1 << n):
            w = place[turn(cell ^ corner, direction + 1)]
            e = corner ^ turn(entry(w), n - (direction + 1) % n)
            nexts.append(e * n + (direction + way(w) + 1) % n)
            digits.append(w)
    return nexts, digits


def hilbert_index(codes: Sequence[Column], bits: int) -> Column:
    """Place on the curve of the cell whose coordinates are ``codes``, integers of ``bits`` bits."""
    n = len(codes)
    nexts, digits = curve_tables(n)
    # one number holds both answers of a step
    steps = F.array(*[F.lit((s << n) | d) for s, d in zip(nexts, digits, strict=True)])
    cells = F.array(*[
        sum((F.shiftright(c, k).bitwiseAND(F.lit(1)) * F.lit(1 << j) for j, c in enumerate(codes)), F.lit(0)).cast("int")
        for k in reversed(range(bits))])

    def step(acc: Column, cell: Column) -> Column:
        found = F.get(steps, F.shiftright(acc, n * bits).cast("int") * F.lit(1 << n) + cell).cast("long")
        place = acc.bitwiseAND(F.lit((1 << (n * bits)) - 1).cast("long")) * F.lit(1 << n) + found.bitwiseAND(F.lit((1 << n) - 1).cast("long"))
        return F.shiftleft(F.shiftright(found, n), n * bits) + place

    last = F.aggregate(cells, F.lit(0).cast("long"), step)
    return last.bitwiseAND(F.lit((1 << (n * bits)) - 1).cast("long"))


def quantised(rows: DataFrame, column: str, bits: int) -> DataFrame:
    """``rows`` with ``column`` replaced by its equal-count cell number. Null is cell 0; numbers are cut at approximate
    quantiles, other values by the running count of their sorted distinct values, one row each."""
    cells = 1 << bits
    if isinstance(rows.schema[column].dataType, NumericType):
        found = rows.agg(F.percentile_approx(column, [k / cells for k in range(1, cells)], 10_000).alias("cuts")).first()["cuts"]
        cuts = sorted({c for c in found or [] if c is not None})
        code = sum(((F.col(column) > F.lit(c)).cast("int") for c in cuts), F.lit(0))
        return rows.withColumn(column, F.coalesce(code, F.lit(0)).cast("int"))
    values = rows.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy(F.col("_value").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    middle = (F.coalesce(F.sum("n").over(before), F.lit(0)) + F.col("n") / 2) / F.sum("n").over(whole)
    codes = values.select("_value", F.when(F.col("_value").isNull(), 0).otherwise(F.floor(middle * cells)).cast("int").alias("_code"))
    return rows.join(codes, F.col(column).eqNullSafe(F.col("_value"))).withColumn(column, F.col("_code")).drop("_value", "_code")


def hilbert_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                   dims: Sequence[str] = ("source", "lang", "doc_id"), bits: int = 5) -> DataFrame:
    """One row per row of ``docs``: id, ``size`` (UTF-8 bytes + 1), ``text_crc32``, ``curve``, ``shard``, ``slot``.

    The columns ``dims`` and the size are cut into 2 ** ``bits`` cells of equal count each, and the Hilbert curve through
    those cells orders the documents, so a run of the curve spans few values of every dimension and readers can skip
    whole shards by any of them. Equal texts stay together, at the curve place of the highest cells among them. The
    curve is cut into ``shards`` runs of equal bytes: groups above a thousandth of a shard, which are few whatever the
    input, are placed first, and the runs of the others fill up what these leave. Sizes differ by about a thousandth,
    or by a group larger than a shard, which is not split. Slots follow the curve.

    Null texts count as no bytes and equal the empty text; null metadata is cell 0; null ids come first. Rows that
    repeat an id and a text get a slot each. Only the columns named are read. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    names = [f"_d{i}" for i in range(len(dims))]
    rows = stored(docs.select(
        F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"), *[F.col(f"`{d}`").alias(n) for d, n in zip(dims, names, strict=True)]), "shard-rows")
    coded = rows.withColumn("_size", F.col("size"))
    for name in [*names, "_size"]:
        coded = quantised(coded, name, bits)
    groups = coded.groupBy("digest").agg(*[F.max(n).alias(n) for n in [*names, "_size"]], F.sum("size").alias("bytes"))
    groups = groups.select("digest", "bytes", hilbert_index([F.col(n) for n in [*names, "_size"]], bits).alias("curve"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]

    large = F.col("bytes") * (shards * 1000) > F.lit(total)
    runs = running_totals(groups, ["curve", "digest"], {"upto": F.col("bytes"), "small_upto": F.when(large, 0).otherwise(F.col("bytes"))}, "shard-groups")
    own = F.least(F.floor((F.col("upto") + F.col("bytes") / 2) * shards / F.lit(float(max(total, 1)))), F.lit(shards - 1)).cast("int")
    runs = stored(runs.withColumn("large", large).withColumn("own", own), "shard-runs")
    held = {r["own"]: r["bytes"] for r in runs.where("large").groupBy("own").agg(F.sum("bytes").alias("bytes")).collect()}  # a row a shard
    room = [max(0.0, total / shards - held.get(s, 0)) for s in range(shards)]
    small = total - sum(held.values())
    scale = small / sum(room) if sum(room) else 0.0
    ends = [scale * sum(room[:s + 1]) for s in range(shards - 1)]
    fill = sum(((F.col("small_upto") + F.col("bytes") / 2 > F.lit(float(e))).cast("int") for e in ends), F.lit(0))
    placed = runs.select("digest", "curve", F.when(F.col("large"), F.col("own")).otherwise(fill).cast("int").alias("shard"))

    dealt = rows.select("id", "size", "text_crc32", "digest").join(placed, "digest")
    slots = running_totals(dealt, ["shard", "curve", "digest", "id"], {"slot": F.lit(1)}, "shard-slots", within=["shard"])
    return slots.select(F.col("id").alias(id_col), "size", "text_crc32", "curve", "shard", "slot")


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write ``docs`` to ``path``, one folder per shard, rows in slot order. Ids must tell documents apart."""
    rows = docs.join(placed.select(id_col, "shard", "slot"), id_col)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
