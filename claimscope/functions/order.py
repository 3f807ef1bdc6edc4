"""Exact order statistics and running totals that never put a whole column in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil, floor, inf

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscope.session import cut_lineage


# Half-widths, as shares of all rows, of the brackets around a wanted rank; the last is everything.
_MARGINS = (3e-3, 3e-2, 1.0)
# Size of a sketch (some 60 kB); its rank error is mostly within a third of the first margin.
_SKETCH_K = 4_000
# First-step mergers of sketches: a task's sketch goes to one of these, not all to one task.
_SKETCH_GROUPS = 256
_NARROW_STEPS = 200


def exact_percentiles(
    df: DataFrame,
    columns: Mapping[str, Column],
    probs: Sequence[float],
    interpolate: bool = True,
    most_inside: int = 5_000_000,
) -> dict[str, list[float | None]]:
    """Exact quantiles of every column, in two passes over ``df``, more on very large tables.

    A mergeable sketch brackets each wanted rank between two values. While a bracket may still
    hold more than ``most_inside`` values, a sketch of the bracket alone narrows it. The last pass keeps single values inside the brackets only and folds all values of a gap between
    brackets into one counter, before anything is shuffled. A rank found outside its bracket
    (sketches are approximate) is looked for again in a wider one, so the result is exact.
    The driver sees a few numbers per column and quantile.

    Nulls and NaN are left out; a column without values gives ``None``. Between neighbours the
    result is linear, or the lower neighbour without ``interpolate``.
    """
    names = list(columns)
    if not names:
        return {}
    values = df.select(*[F.nanvl(columns[n].cast("double"), F.lit(None)).alias(f"v{i}")
                         for i, n in enumerate(names)])
    shares = [min(max(p + sign * m, 0.0), 1.0) for m in _MARGINS for p in probs for sign in (-1, 1)]
    sketches = _sketch(values, {i: (F.col(f"v{i}"), F.lit(0)) for i in range(len(names))}, shares)
    counts = {i: sketches[i][0] for i in range(len(names))}
    wanted = {i: sorted({r for p in probs for r in (floor((n - 1) * p), ceil((n - 1) * p))}) for i, n in counts.items() if n}

    # a bracket must span some ranks besides the error of the sketch
    level = {i: next(k for k, m in enumerate(_MARGINS) if m * counts[i] >= 5 or m == 1.0) for i in wanted}
    width = 2 * len(probs)

    def brackets_at(i: int) -> list[tuple[float, float]]:
        edges = sketches[i][2][level[i] * width:(level[i] + 1) * width]
        return [(edges[k], edges[k + 1]) for k in range(0, width, 2)]

    spans: dict[int, list[tuple[float, float]]] = {}
    misses = dict.fromkeys(wanted, 0)

    def tighten(columns: Sequence[int]) -> None:
        """Brackets of the columns' level, narrowed until few values can be inside. A column that was missed before keeps
        more room on either side of each narrowed bracket."""
        spans.update({i: brackets_at(i) for i in columns})
        inside = {i: 2 * _MARGINS[level[i]] * counts[i] for i in columns}
        for _ in range(6):
            large = {i: spans[i] for i in columns if inside[i] > most_inside and any(lo < hi for lo, hi in spans[i])}
            if not large:
                return
            room = {i: 4 ** misses[i] for i in large}
            narrowed = _narrow(values, large, {i: [(counts[i] - 1) * p for p in probs] for i in large}, room)
            # brackets that do not shrink hold a few values many times over: little is left to count
            inside.update({i: inside[i] * (1 + 2 * room[i]) / _NARROW_STEPS if narrowed[i] != spans[i] else 0 for i in large})
            spans.update(narrowed)

    tighten(list(wanted))
    found: dict[tuple[int, int], float] = {}
    pending = wanted
    while True:
        found |= _values_at(values, {i: _merge(spans[i]) for i in pending}, pending) if pending else {}
        pending = {i: rest for i, ranks in pending.items() if (rest := [r for r in ranks if (i, r) not in found])}
        if not pending:
            break
        for i in pending:
            if spans[i] == brackets_at(i) or misses[i] > 1:
                level[i], misses[i] = min(level[i] + 1, len(_MARGINS) - 1), 0
            else:
                misses[i] += 1
        tighten(list(pending))

    out: dict[str, list[float | None]] = {}
    for i, name in enumerate(names):
        out[name] = []
        for p in probs:
            if i not in wanted:
                out[name].append(None)
                continue
            rank = (counts[i] - 1) * p
            a, b = found[i, floor(rank)], found[i, ceil(rank)]
            out[name].append(a + (b - a) * (rank - floor(rank)) if interpolate else a)
    return out


def _sketch(
    values: DataFrame, parts: Mapping[int, tuple[Column, Column]], shares: Sequence[float]
) -> dict[int, tuple[int, int, list[float]]]:
    """Per part, from its ``(value, count)`` columns: values seen, the count's sum, quantiles.

    Sketches are merged in three steps, at first in up to the square of ``_SKETCH_GROUPS`` groups and then in
    ``_SKETCH_GROUPS``, so no single task takes in one sketch per input task.
    """
    keys = list(parts)
    rows = values.select(
        (F.spark_partition_id() % _SKETCH_GROUPS**2).alias("group"),
        *[x for j, k in enumerate(keys) for x in (parts[k][0].alias(f"x{j}"), parts[k][1].alias(f"c{j}"))])
    some = rows.groupBy("group").agg(*[
        x for j in range(len(keys))
        for x in (F.kll_sketch_agg_double(f"x{j}", F.lit(_SKETCH_K)).alias(f"k{j}"), F.sum(f"c{j}").alias(f"c{j}"))])

    def merge(grouped) -> DataFrame:
        return grouped.agg(*[
            x for j in range(len(keys))
            for x in (F.kll_merge_agg_double(f"k{j}", F.lit(_SKETCH_K)).alias(f"k{j}"), F.coalesce(F.sum(f"c{j}"), F.lit(0)).alias(f"c{j}"))])

    merged = merge(merge(some.groupBy((F.col("group") % _SKETCH_GROUPS).alias("group"))).groupBy())
    seen = merged.withColumns({f"n{j}": F.coalesce(F.kll_sketch_get_n_double(f"k{j}"), F.lit(0)) for j in range(len(keys))})
    wanted = F.array(*[F.lit(s) for s in shares])
    row = seen.select(
        *[x for j in range(len(keys)) for x in (f"n{j}", f"c{j}")],
        *[F.when(F.col(f"n{j}") > 0, F.kll_sketch_get_quantile_double(f"k{j}", wanted)).alias(f"q{j}")
          for j in range(len(keys))],
    ).first()
    return {k: (row[f"n{j}"], row[f"c{j}"], row[f"q{j}"] or []) for j, k in enumerate(keys)}


def _narrow(
    values: DataFrame, spans: Mapping[int, list[tuple[float, float]]], ranks: Mapping[int, list[float]],
    room: Mapping[int, int],
) -> dict[int, list[tuple[float, float]]]:
    """Narrower brackets for the given ranks, from a sketch of each bracket's own values."""
    steps = _NARROW_STEPS
    grid = [k / steps for k in range(steps + 1)]
    out: dict[int, list[tuple[float, float]]] = {}
    for j in range(max(len(s) for s in spans.values())):
        parts = {}
        for i, of_column in spans.items():
            v, (lo, hi) = F.col(f"v{i}"), of_column[j]
            parts[i] = (F.when((v >= lo) & (v <= hi), v), F.when(v < lo, 1).otherwise(0))
        for i, (n, below, edges) in _sketch(values, parts, grid).items():
            at = (ranks[i][j] - below) / n * steps if n else 0.0
            lo, hi = min(max(floor(at) - room[i], 0), steps), min(max(ceil(at) + room[i], 0), steps)
            out.setdefault(i, []).append((edges[lo], edges[hi]) if n else spans[i][j])
    return out


def _values_at(
    values: DataFrame, brackets: Mapping[int, list[tuple[float, float]]], ranks: Mapping[int, list[int]]
) -> dict[tuple[int, int], float]:
    """Values at the given ranks of each column, for the ranks that lie inside a bracket."""
    cells = []
    for i, spans in brackets.items():
        v = F.col(f"v{i}")
        at, gap = F.when(v < spans[0][0], -inf), F.when(v < spans[0][0], 1)
        for k, (lo, hi) in enumerate(spans):
            at, gap = at.when(v <= hi, v), gap.when(v <= hi, 0)
            if k + 1 < len(spans):
                at, gap = at.when(v < spans[k + 1][0], hi), gap.when(v < spans[k + 1][0], 1)
        # values above the last bracket precede no wanted rank: null, dropped below
        cells.append(F.struct(F.lit(i).alias("name"), at.alias("at"), gap.alias("gap")))
    histogram = (
        values.select(F.inline(F.array(*cells)))
        .filter("at IS NOT NULL")
        .groupBy("name", "at", "gap")
        .agg(F.count("*").alias("n"))
    )
    upto = F.sum("n").over(
        Window.partitionBy("name").orderBy("at", "gap").rowsBetween(Window.unboundedPreceding, 0)
    )
    targets = F.create_map(*[
        x for i, rs in ranks.items() for x in (F.lit(i), F.array(*[F.lit(r).cast("bigint") for r in rs]))])
    rows = (
        histogram.withColumn("upto", upto)
        .filter("gap = 0")
        .select("name", "at", F.explode(targets[F.col("name")]).alias("rank"), "upto", "n")
        .filter("rank >= upto - n AND rank < upto")
        .select("name", "rank", "at")
        .collect()
    )
    return {(r["name"], r["rank"]): r["at"] for r in rows}


def _merge(brackets: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Overlapping or touching brackets as one, in ascending order."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def running_totals(df: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``<name>_upto``: the sum of ``name`` over rows ordered up to and including this one.

    ``df`` is already aggregated to one row per ``(by, order)``. Rows go to even ranges of ``(by, order)`` themselves,
    cut at sampled values, and are stored; sums run inside a range, and the totals of earlier ranges, one row each, are
    joined on. The number of ranges is that of the shuffle, so it grows with the cluster's setting and not with the keys.
    """
    placed = df.repartitionByRange(*by, order).withColumn("_range", F.spark_partition_id())
    placed = cut_lineage(placed, "ordered")
    totals = placed.groupBy(*by, "_range").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(b).alias(f"_by_{b}") for b in by], F.col("_range").alias("_at"),
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums])
    on = F.col("_range") == F.col("_at")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    inner = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumns({f"_r_{s}": F.sum(s).over(inner) for s in sums}).join(offsets, on)
        .select(*df.columns, *[(F.col(f"_r_{s}") + F.col(f"_o_{s}")).alias(f"{s}_upto") for s in sums])
    )


def unpivot_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), cast: str = "double") -> DataFrame:
    """Rows ``(keep…, feature, value)``, one per input row and column, in a single pass."""
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast(cast).alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells)))
