"""Data-quality and contract queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimscope import schema as S
from claimscope.functions.columns import col, percent
from claimscope.operators import contract, quality
from claimscope.plans.registry import query, quoted, rounded
from claimscope.sources.tables import claims, relation


def raw(spark, sf_dir):
    return relation(spark, sf_dir, "claims_raw")


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _rule_rows(source: str, rows, keep: str = "rule, column_name, n_rows, violations, success") -> str:
    """UNION of one line per (rule, column, violation predicate)."""
    union = "\nUNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{column}' AS column_name, count(*) AS n_rows, count(*) FILTER ({bad}) AS violations FROM {source}"
        for rule, column, bad in rows)
    return f"SELECT {keep} FROM (SELECT *, CASE WHEN violations = 0 THEN 1 ELSE 0 END AS success FROM ({union}))"


def _range_rows(ranges, suffix="_out_of_range"):
    return [(f"{c}{suffix}", c, f"{quoted(c)} < {lo} OR {quoted(c)} > {hi}") for c, (lo, hi) in ranges.items()]


_CLEAN_VALUE_ROWS = [
    (f"{c}_invalid_values", c, f"{c} IS NULL OR {c} NOT IN {_in([*v, 'Unknown'])}") for c, v in S.CLEAN_VALUES.items()]
_SET_ROWS = [(f"{c}_not_in_set", c, f"{c} NOT IN {_in(v)}") for c, v in S.RAW_VALUES.items()]
_NULL_ROWS = [(f"{c}_null", c, f"{c} IS NULL") for c in S.NOT_NULL_COLUMNS]
_COLUMNS = ("rule", "column_name", "n_rows", "violations", "success")


@query("dq_required_columns", "SELECT 'is_fraud' AS missing_column, count(*) AS n_rows FROM claims_raw", ["claims_raw"])
def dq_required_columns(spark, sf_dir):
    return quality.missing_columns(raw(spark, sf_dir), S.REQUIRED_COLUMNS)


@query("dq_range", _rule_rows("claims", _range_rows(S.CLEAN_RANGES)), ["claims"])
def dq_range(spark, sf_dir):
    rules = [quality.between(c, lo, hi) for c, (lo, hi) in S.CLEAN_RANGES.items()]
    return quality.run_rules(claims(spark, sf_dir), rules).select(*_COLUMNS)


@query("dq_allowed_values", _rule_rows("claims", _CLEAN_VALUE_ROWS), ["claims"])
def dq_allowed_values(spark, sf_dir):
    rules = [quality.one_of(c, [*v, "Unknown"], null_is_bad=True) for c, v in S.CLEAN_VALUES.items()]
    return quality.run_rules(claims(spark, sf_dir), rules).select(*_COLUMNS)


@query("dq_duplicate_keys", "SELECT count(*) - count(DISTINCT policy_number) AS duplicates FROM claims", ["claims"])
def dq_duplicate_keys(spark, sf_dir):
    return quality.duplicate_count(claims(spark, sf_dir), "policy_number")


@query("dq_report", "SELECT rule AS issue, violations AS n, " + "CASE "
       + " ".join(f"WHEN rule = '{c}_out_of_range' THEN violations || ' rows out of range [{lo}, {hi}]'" for c, (lo, hi) in S.CLEAN_RANGES.items())
       + " ELSE violations || ' rows with invalid values' END AS message FROM ("
       + _rule_rows("claims", _range_rows(S.CLEAN_RANGES) + _CLEAN_VALUE_ROWS)
       + """) WHERE violations > 0
  UNION ALL SELECT 'duplicates', d, d || ' duplicate policy numbers' FROM (SELECT count(*) - count(DISTINCT policy_number) AS d FROM claims) WHERE d > 0""",
       ["claims"])
def dq_report(spark, sf_dir):
    return quality.quality_report(claims(spark, sf_dir), S.REQUIRED_COLUMNS, S.CLEAN_RANGES, S.CLEAN_VALUES, "policy_number")


@query("dq_gate", """SELECT 'raw' AS dataset, 'stopped' AS verdict, count(*) AS n_rows FROM claims_raw
  UNION ALL SELECT 'clean', 'passed', count(*) FROM claims""", ["claims_raw", "claims"])
def dq_gate(spark, sf_dir):
    """Gate on both datasets: raw rows have no target yet, so their load stops."""
    lines = []
    for name, df in (("raw", raw(spark, sf_dir)), ("clean", claims(spark, sf_dir))):
        report = quality.quality_report(df, S.REQUIRED_COLUMNS, S.CLEAN_RANGES, S.CLEAN_VALUES, "policy_number")
        try:
            quality.quality_gate(report)
            verdict = "passed"
        except quality.CriticalIssue:
            verdict = "stopped"
        lines.append(df.agg(F.lit(name).alias("dataset"), F.lit(verdict).alias("verdict"), F.count("*").alias("n_rows")))
    return lines[0].unionByName(lines[1])


@query("dq_expect_column_order",
       "SELECT 0 AS success, '" + ", ".join(f.name for f in S.RAW_SCHEMA) + "' AS observed, '"
       + ", ".join(S.EXPECTED_ORDER) + "' AS expected, count(*) AS n_rows FROM claims_raw", ["claims_raw"])
def dq_expect_column_order(spark, sf_dir):
    df = raw(spark, sf_dir).select(*[col(f.name) for f in S.RAW_SCHEMA])
    return quality.column_order_check(df, S.EXPECTED_ORDER)


@query("dq_expect_between", _rule_rows("claims_raw", _range_rows(S.RAW_RANGES)), ["claims_raw"])
def dq_expect_between(spark, sf_dir):
    rules = [quality.between(c, lo, hi) for c, (lo, hi) in S.RAW_RANGES.items()]
    return quality.run_rules(raw(spark, sf_dir), rules).select(*_COLUMNS)


@query("dq_expect_in_set", _rule_rows("claims_raw", _SET_ROWS), ["claims_raw"])
def dq_expect_in_set(spark, sf_dir):
    rules = [quality.one_of(c, v, null_is_bad=False, name=f"{c}_not_in_set") for c, v in S.RAW_VALUES.items()]
    return quality.run_rules(raw(spark, sf_dir), rules).select(*_COLUMNS)


@query("dq_expect_not_null", _rule_rows("claims_raw", _NULL_ROWS), ["claims_raw"])
def dq_expect_not_null(spark, sf_dir):
    return quality.run_rules(raw(spark, sf_dir), [quality.not_null(c) for c in S.NOT_NULL_COLUMNS]).select(*_COLUMNS)


@query("dq_expect_unique", """SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS violations
  FROM (SELECT policy_number, count(*) AS n FROM claims_raw GROUP BY policy_number HAVING count(*) > 1)""", ["claims_raw"])
def dq_expect_unique(spark, sf_dir):
    return quality.repeated_rows(raw(spark, sf_dir), "policy_number")


_SUITE_RANGES = {c: S.RAW_RANGES[c] for c in ("age", "months_as_customer", "policy_annual_premium", "total_claim_amount")}
_SUITE_SETS = [r for r in _SET_ROWS if r[1] in ("policy_state", "incident_severity")]


@query("dq_suite_run", "SELECT *, min(success) OVER () AS suite_success, count(*) OVER () AS evaluated, "
       "CAST(sum(success) OVER () AS BIGINT) AS successful FROM ("
       + _rule_rows("claims_raw", _range_rows(_SUITE_RANGES) + _SUITE_SETS + _NULL_ROWS, "rule, column_name, violations, success")
       + ")", ["claims_raw"])
def dq_suite_run(spark, sf_dir):
    rules = [quality.between(c, lo, hi) for c, (lo, hi) in _SUITE_RANGES.items()]
    rules += [quality.one_of(c, S.RAW_VALUES[c], null_is_bad=False, name=f"{c}_not_in_set") for c in ("policy_state", "incident_severity")]
    rules += [quality.not_null(c) for c in S.NOT_NULL_COLUMNS]
    return quality.suite(raw(spark, sf_dir), rules)


_NUMERIC_SQL = " ".join(f"WHEN {c} < 0 THEN 'Field {c} must be non-negative'" for c in S.CONTRACT_NUMERIC)
_ERROR_SQL = f"""CASE WHEN policy_state <> '' AND policy_state NOT IN {_in(S.RAW_VALUES['policy_state'])} THEN 'Invalid policy_state: ' || policy_state
  WHEN incident_severity <> '' AND incident_severity NOT IN {_in(S.RAW_VALUES['incident_severity'])} THEN 'Invalid incident_severity: ' || incident_severity
  {_NUMERIC_SQL} END"""


@query("contract_validate", f"""SELECT policy_number, incident_date, error, CASE WHEN error IS NULL THEN 1 ELSE 0 END AS valid
  FROM (SELECT policy_number, incident_date, {_ERROR_SQL} AS error FROM claims_raw)""", ["claims_raw"])
def contract_validate(spark, sf_dir):
    return contract.validate_records(raw(spark, sf_dir)).select("policy_number", "incident_date", "error", "valid")


@query("contract_enrich", f"""SELECT policy_number, incident_date, CASE WHEN error IS NULL THEN 1 ELSE 0 END AS valid,
  coalesce(error, '') AS errors, incident_date AS validated_at,
  CASE WHEN error IS NULL THEN incident_date END AS "timestamp"
  FROM (SELECT policy_number, incident_date, {_ERROR_SQL} AS error FROM claims_raw)""", ["claims_raw"])
def contract_enrich(spark, sf_dir):
    """Stamped with the incident date here, so the result is repeatable."""
    out = contract.enrich_records(raw(spark, sf_dir), at=F.col("incident_date"))
    return out.select("policy_number", "incident_date", "valid", F.array_join("errors", "; ").alias("errors"), "validated_at", "timestamp")


def _schema_rows() -> str:
    kinds = {f.name: f.dataType.simpleString() for f in S.RAW_SCHEMA}
    fits = {"int": ("int", "bigint"), "double": ("double",), "string": ("string",)}
    lines = []
    for name, expected, nullable in S.CONTRACTS["v1"]:
        actual = kinds.get(name)
        empty = f"count(*) FILTER ({name} IS NULL)" if actual else "count(*)"
        good = "TRUE" if actual in fits[expected] else "FALSE"
        need = "TRUE" if nullable else f"{empty} = 0"
        symbols = S.CONTRACT_ENUMS["v1"].get(name)
        odd = f"count(*) FILTER ({name} NOT IN {_in(symbols)})" if symbols and actual else "0::BIGINT"
        lines.append(f"SELECT '{name}' AS field, '{expected}' AS expected, {repr(actual) if actual else 'CAST(NULL AS VARCHAR)'} AS actual, "
                     f"{empty} AS nulls, {odd} AS unknown_symbols, CASE WHEN {good} AND {need} AND {odd} = 0 THEN 1 ELSE 0 END AS ok FROM claims_raw")
    return "\nUNION ALL ".join(lines)


@query("contract_schema_check", _schema_rows(), ["claims_raw"])
def contract_schema_check(spark, sf_dir):
    return contract.compare_schema(raw(spark, sf_dir), "v1")


@query("request_bounds", _rule_rows(
    "claims_raw",
    [(f"{c}_null", c, f"{c} IS NULL") for c in [b[0] for b in S.REQUEST_BOUNDS] + [n[0] for n in S.REQUEST_LENGTHS]]
    + [(f"{c}_out_of_range", c, f"{c} < {lo}" + (f" OR {c} > {hi}" if hi is not None else "")) for c, lo, hi in S.REQUEST_BOUNDS]
    + [(f"{c}_too_long", c, f"length({c}) > {n}") for c, n in S.REQUEST_LENGTHS]), ["claims_raw"])
def request_bounds(spark, sf_dir):
    names = [b[0] for b in S.REQUEST_BOUNDS] + [n[0] for n in S.REQUEST_LENGTHS]
    rules = [quality.not_null(c) for c in names]
    rules += [quality.between(c, lo, hi) for c, lo, hi in S.REQUEST_BOUNDS]
    rules += [quality.at_most_long(c, n) for c, n in S.REQUEST_LENGTHS]
    return quality.run_rules(raw(spark, sf_dir), rules).select(*_COLUMNS)


_RAW_NAMES = [f.name for f in S.RAW_SCHEMA]
_BAD_SQL = " OR ".join(f"coalesce({bad}, FALSE)" for _, _, bad in _range_rows(S.CLEAN_RANGES) + _CLEAN_VALUE_ROWS)


@query("dq_profile", "SELECT count(*) AS row_count, CAST(sum(nulls) AS BIGINT) AS null_count, "
       "count(*) - count(DISTINCT policy_number) AS duplicate_count, "
       + rounded(f"1 - sum(nulls)::DOUBLE / (count(*) * {len(_RAW_NAMES)})", 6) + " AS completeness, "
       + rounded("1 - (count(*) FILTER (bad))::DOUBLE / count(*)", 6) + " AS validity FROM (SELECT policy_number, "
       + " + ".join(f"CASE WHEN {quoted(c)} IS NULL THEN 1 ELSE 0 END" for c in _RAW_NAMES)
       + f" AS nulls, {_BAD_SQL} AS bad FROM claims_raw)", ["claims_raw"])
def dq_profile(spark, sf_dir):
    return quality.profile(raw(spark, sf_dir), "policy_number", S.CLEAN_RANGES, S.CLEAN_VALUES)


@query("load_quality_score", "SELECT run_id, " + rounded("rows_transformed * 100.0 / rows_extracted", 1)
       + " AS data_quality_score FROM run_log", ["run_log"])
def load_quality_score(spark, sf_dir):
    return relation(spark, sf_dir, "run_log").select(
        "run_id", percent(F.col("rows_transformed"), F.col("rows_extracted"), 100, 1).alias("data_quality_score"))
