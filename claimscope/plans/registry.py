"""Named queries, each with the SQL that computes the same rows on another engine."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from claimscope.schema import (
    AGE_EDGES, AGE_LABELS, DERIVED_COLUMNS, FINAL_COLUMNS, NUMERIC_COLUMNS, STRING_COLUMNS,
    TENURE_EDGES, TENURE_LABELS,
)
from claimscope.sources.relations import RELATIONS, for_duckdb

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None, reads: Sequence[str] = ()) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the relations in ``reads`` and the base tables."""

    def add(run: Query) -> Query:
        QUERIES[key] = run
        if sql is not None:
            SQL[key] = with_relations(reads, sql)
        return run

    return add


def rounded(expr: str, digits: int) -> str:
    """Half-up rounding in decimal, back to a double."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def quoted(name: str) -> str:
    return f'"{name}"'


def _bins(column: str, edges: Sequence[float], labels: Sequence[str]) -> str:
    whens = " ".join(f"WHEN {column} <= {hi} THEN '{label}'" for hi, label in zip(edges[1:], labels, strict=True))
    return f"CASE WHEN {column} <= {edges[0]} THEN NULL {whens} END"


def title_sql(expr: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(trim({expr}), '([\\p{{L}}]+|[^\\p{{L}}]+)'), "
        "lambda s: upper(s[1]) || lower(s[2:])), '')"
    )


MEDIANS_SQL = "SELECT " + ", ".join(
    f"quantile_cont(CAST({quoted(c)} AS DOUBLE), 0.5) AS {quoted(c)}" for c in NUMERIC_COLUMNS
) + " FROM claims_raw"

FILLED_SQL = "SELECT " + ", ".join(
    [f"coalesce(CAST(r.{quoted(c)} AS DOUBLE), (SELECT m.{quoted(c)} FROM medians m)) AS {quoted(c)}"
     for c in NUMERIC_COLUMNS]
    + [f"coalesce(r.{quoted(c)}, 'Unknown') AS {quoted(c)}" for c in [*STRING_COLUMNS, "fraud_reported"]]
    + ["r.incident_date"]
) + " FROM claims_raw r"

_DERIVED_SQL = {
    "has_claim": "CASE WHEN total_claim_amount > 0 THEN 1 ELSE 0 END",
    "age_group": _bins("age", AGE_EDGES, AGE_LABELS),
    "tenure_group": _bins("months_as_customer", TENURE_EDGES, TENURE_LABELS),
    "is_fraud": "CASE WHEN fraud_reported = 'Y' THEN 1 ELSE 0 END",
}
CLAIMS_SQL = "SELECT " + ", ".join(
    f"{title_sql(quoted(c))} AS {quoted(c)}" if c in STRING_COLUMNS
    else f"{_DERIVED_SQL[c]} AS {quoted(c)}" if c in DERIVED_COLUMNS
    else quoted(c)
    for c in FINAL_COLUMNS
) + " FROM filled"

_RATIO = "CAST({0} AS DOUBLE) / nullif(CAST({1} AS DOUBLE), 0)"
STAGING_SQL = "SELECT " + ", ".join(
    f"{quoted(c)} AS {c.replace('-', '_')}" for c in FINAL_COLUMNS
) + (
    ", trim(lower(policy_state)) AS policy_state_clean, trim(lower(incident_severity)) AS incident_severity_clean, "
    + _RATIO.format("total_claim_amount", "policy_annual_premium") + " AS claim_to_premium_ratio, "
    + _RATIO.format("vehicle_claim", "total_claim_amount") + " AS vehicle_claim_ratio, "
    + _RATIO.format("injury_claim", "total_claim_amount") + " AS injury_claim_ratio FROM claims"
)

_EXTRA = {
    "medians": (MEDIANS_SQL, ["claims_raw"]),
    "filled": (FILLED_SQL, ["claims_raw", "medians"]),
    "claims": (CLAIMS_SQL, ["filled"]),
    "stg_claims": (STAGING_SQL, ["claims"]),
}


def define(name: str, sql: str, reads: Sequence[str]) -> None:
    """Add a shared relation for the SQL side."""
    _EXTRA[name] = (sql, list(reads))


def with_relations(reads: Sequence[str], body: str) -> str:
    seen: list[str] = []

    def visit(name: str) -> None:
        needs = _EXTRA[name][1] if name in _EXTRA else RELATIONS[name][1] if name in RELATIONS else None
        if needs is None or name in seen:
            return
        for need in needs:
            visit(need)
        seen.append(name)

    for name in reads:
        visit(name)
    body = body.strip()
    if not seen:
        return body
    parts = []
    for name in seen:
        text = _EXTRA[name][0] if name in _EXTRA else for_duckdb(name)
        parts.append(f"{name} AS MATERIALIZED ({text})")
    start = next((w for w in ("WITH RECURSIVE ", "WITH ") if body.upper().startswith(w)), "")
    head = (start or "WITH ") + ",\n".join(parts)
    return f"{head}, {body[len(start):]}" if start else f"{head}\n{body}"
