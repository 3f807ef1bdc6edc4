"""Data-quality rules: each rule is a violation predicate, one aggregate counts them all."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscope.functions.columns import col


@dataclass(frozen=True)
class Rule:
    """``violation`` is true for a bad value; false and null are both fine."""

    name: str
    column: str
    violation: Column
    message: str = "{n} rows"


def between(column: str, low: float | None, high: float | None, name: str | None = None) -> Rule:
    c, bad = col(column), F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return Rule(name or f"{column}_out_of_range", column, bad, f"{{n}} rows out of range [{low}, {high}]")


def one_of(column: str, values: Sequence[str], null_is_bad: bool, name: str | None = None) -> Rule:
    known = col(column).isin(list(values))
    bad = ~F.coalesce(known, F.lit(False)) if null_is_bad else ~known
    return Rule(name or f"{column}_invalid_values", column, bad, "{n} rows with invalid values")


def not_null(column: str, name: str | None = None) -> Rule:
    return Rule(name or f"{column}_null", column, col(column).isNull())


def at_most_long(column: str, length: int, name: str | None = None) -> Rule:
    return Rule(name or f"{column}_too_long", column, F.length(col(column)) > length)


_RESULT = "array<struct<rule: string, column_name: string, n_rows: bigint, violations: bigint, success: int, message: string>>"


def run_rules(df: DataFrame, rules: Sequence[Rule], absent_fails: bool = True) -> DataFrame:
    """One row per rule: ``rule, column_name, n_rows, violations, success, message``; a single pass.

    A rule whose column the table lacks fails for all its rows, or is left out with ``absent_fails=False``.
    """
    rules = [r for r in rules if absent_fails or r.column in df.columns]
    there = [r.column in df.columns for r in rules]
    counts = df.agg(F.count("*").alias("n_rows"), *[F.count_if(r.violation).alias(f"r{i}") for i, r in enumerate(rules) if there[i]])

    def line(i: int, rule: Rule) -> Column:
        head = [F.lit(rule.name).alias("rule"), F.lit(rule.column).alias("column_name"), F.col("n_rows")]
        if not there[i]:
            return F.struct(*head, F.col("n_rows").alias("violations"), F.lit(0).alias("success"),
                            F.lit(f"column {rule.column} is missing").alias("message"))
        before, after = rule.message.split("{n}")
        text = F.concat(F.lit(before), F.col(f"r{i}").cast("string"), F.lit(after))
        return F.struct(*head, F.col(f"r{i}").alias("violations"), (F.col(f"r{i}") == 0).cast("int").alias("success"), text.alias("message"))

    return counts.select(F.inline(F.array(*[line(i, r) for i, r in enumerate(rules)]).cast(_RESULT)))


def missing_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column the table lacks, with the number of rows affected."""
    lacking = [c for c in required if c not in df.columns]
    rows = df.agg(F.count("*").alias("n_rows"))
    names = F.array(*[F.lit(c) for c in lacking]) if lacking else F.array().cast("array<string>")
    return rows.select(F.explode(names).alias("missing_column"), "n_rows")


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows after the first of each key; nulls count as one key."""
    return df.groupBy(col(key)).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def repeated_rows(df: DataFrame, key: str) -> DataFrame:
    """All rows of every key that occurs more than once."""
    return df.filter(col(key).isNotNull()).groupBy(col(key)).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("violations"))


def quality_report(
    df: DataFrame,
    required: Sequence[str],
    ranges: Mapping[str, tuple[float, float]],
    values: Mapping[str, Sequence[str]],
    key: str,
) -> DataFrame:
    """``issue, n, message`` for every issue found: missing columns, ranges, values, duplicates."""
    rules = [between(c, lo, hi) for c, (lo, hi) in ranges.items()]
    rules += [one_of(c, [*v, "Unknown"], null_is_bad=True) for c, v in values.items()]
    out = run_rules(df, rules, absent_fails=False).select(F.col("rule").alias("issue"), F.col("violations").alias("n"), "message")
    if key in df.columns:
        dupes = duplicate_count(df, key).select(
            F.lit("duplicates").alias("issue"), F.col("duplicates").alias("n"),
            F.concat(F.col("duplicates").cast("string"), F.lit(" duplicate policy numbers")).alias("message"))
        out = out.unionByName(dupes)
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        # the table lacks these by its schema, so they are reported even when it has no rows
        gone = df.agg(F.lit(len(lacking)).cast("bigint").alias("n")).select(
            F.lit("missing_columns").alias("issue"), "n", F.lit(", ".join(lacking)).alias("message"))
        out = out.unionByName(gone)
    return out.filter("n > 0")


class CriticalIssue(ValueError):
    """A load must stop."""


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise CriticalIssue(f"Critical validation issues: missing_columns: {', '.join(lacking)}")


def quality_gate(report: DataFrame, critical: Sequence[str] = ("missing_columns",)) -> list[tuple[str, str]]:
    """Raise if a critical issue is in the report; return the others as warnings."""
    issues = [(r["issue"], r["message"]) for r in report.select("issue", "message").collect()]
    if any(issue in critical for issue, _ in issues):
        raise CriticalIssue(f"Critical validation issues: {issues}")
    return issues


def column_order_check(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Whether the columns are exactly the expected ones, in order."""
    same = list(df.columns) == list(expected)
    return df.agg(F.count("*").alias("n_rows")).select(
        F.lit(int(same)).alias("success"), F.lit(", ".join(df.columns)).alias("observed"),
        F.lit(", ".join(expected)).alias("expected"), "n_rows")


def suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rules of a suite with the verdict of the whole suite on every row; one pass over ``df``, one row per rule after it."""
    results = run_rules(df, rules).select("rule", "column_name", "violations", "success")
    whole = Window.partitionBy()
    return results.withColumns({
        "suite_success": F.min("success").over(whole), "evaluated": F.count("*").over(whole), "successful": F.sum("success").over(whole)})


def profile(df: DataFrame, key: str, ranges: Mapping[str, tuple[float, float]], values: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows, nulls, duplicates, share of filled cells, share of rows that pass every rule."""
    rules = [between(c, lo, hi) for c, (lo, hi) in ranges.items() if c in df.columns]
    rules += [one_of(c, [*v, "Unknown"], null_is_bad=True) for c, v in values.items() if c in df.columns]
    bad = F.lit(False)
    for r in rules:
        bad = bad | F.coalesce(r.violation, F.lit(False))
    nulls = F.lit(0)
    for c in df.columns:
        nulls = nulls + F.when(col(c).isNull(), 1).otherwise(0)
    facts = df.select(nulls.alias("nulls"), bad.alias("bad")).agg(
        F.count("*").alias("row_count"), F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_count"),
        F.count_if("bad").alias("bad_count"))
    n = F.col("row_count")
    return facts.select(
        "row_count", "null_count", duplicate_count(df, key).scalar().alias("duplicate_count"),
        F.round(1 - F.try_divide(F.col("null_count").cast("double"), n.cast("double") * len(df.columns)), 6).alias("completeness"),
        F.round(1 - F.try_divide(F.col("bad_count").cast("double"), n.cast("double")), 6).alias("validity"),
    )
