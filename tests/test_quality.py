from __future__ import annotations

import pytest

from claimscope import schema as S
from claimscope.operators import contract, quality


def issues(df):
    report = quality.quality_report(df, S.REQUIRED_COLUMNS, S.CLEAN_RANGES, S.CLEAN_VALUES, "policy_number")
    return {r["issue"]: r["message"] for r in report.collect()}


def test_dirty_rows(dirty):
    found = issues(dirty)
    assert found["age_out_of_range"] == "2 rows out of range [18, 100]"
    assert found["total_claim_amount_out_of_range"] == "1 rows out of range [0, 1000000]"
    assert "missing_columns" in found and "duplicates" not in found


def test_null_counts_as_bad_value_but_not_as_out_of_range(spark):
    df = spark.createDataFrame([("POL1", None, None), ("POL1", 30, "Oh")], "policy_number string, age int, policy_state string")
    found = issues(df)
    assert found["policy_state_invalid_values"] == "1 rows with invalid values"
    assert found["duplicates"] == "1 duplicate policy numbers"
    assert "age_out_of_range" not in found


def test_suite_ignores_null_and_counts_all_repeats(spark):
    df = spark.createDataFrame([("a", None), ("a", "OH"), ("b", "XX")], "policy_number string, policy_state string")
    rows = quality.run_rules(df, [quality.one_of("policy_state", S.RAW_VALUES["policy_state"], null_is_bad=False)]).collect()
    assert rows[0]["violations"] == 1 and rows[0]["success"] == 0
    assert quality.repeated_rows(df, "policy_number").first()[0] == 2


def test_gate(dirty, spark):
    report = quality.quality_report(dirty, S.REQUIRED_COLUMNS, S.CLEAN_RANGES, S.CLEAN_VALUES, "policy_number")
    with pytest.raises(quality.CriticalIssue):
        quality.quality_gate(report)
    with pytest.raises(quality.CriticalIssue):
        quality.require_columns(dirty, S.REQUIRED_COLUMNS)
    ok = quality.quality_report(dirty, ["age"], S.CLEAN_RANGES, S.CLEAN_VALUES, "policy_number")
    assert [i for i, _ in quality.quality_gate(ok)]


RECORD = "policy_number string, months_as_customer string, age int, policy_state string, policy_annual_premium double, total_claim_amount double, incident_severity string"


@pytest.mark.parametrize(("row", "error"), [
    (("POL1", None, 35, "OH", 1500.0, 5000.0, "Minor Damage"), None),
    (("POL1", None, 35, "OH", float("nan"), 5000.0, "Minor Damage"), None),
    (("POL1", "24", 35, "OH", 1500.0, 5000.0, None), "Field months_as_customer must be numeric"),
    (("POL1", None, None, "", 1500.0, 5000.0, None), None),
    (("POL1", None, 35, "INVALID", -1.0, 5000.0, "x"), "Invalid policy_state: INVALID"),
    (("POL1", None, 35, None, 1.0, 5000.0, "Bad"), "Invalid incident_severity: Bad"),
    (("POL1", "abc", -1, "OH", 1.0, 5000.0, None), "Field months_as_customer must be numeric"),
    (("POL1", None, 35, "OH", -100.0, 5000.0, None), "Field policy_annual_premium must be non-negative"),
])
def test_contract_first_error(spark, row, error):
    out = contract.validate_records(spark.createDataFrame([row], RECORD)).first()
    assert out["error"] == error and out["valid"] == int(error is None)


def test_contract_missing_field_and_version(spark, dirty):
    assert contract.validate_records(dirty).first()["error"] == "Missing required field: policy_state"
    assert contract.validate_records(dirty, "v9").first()["error"] == "Unknown schema version: v9"
    row = contract.compare_schema(dirty, "v9").first()
    assert (row["field"], row["actual"], row["ok"]) == ("version", "v9", 0)


def test_schema_check_knows_the_symbols(spark):
    df = spark.createDataFrame([("OH", "M"), ("XX", None)], "policy_state string, insured_sex string")
    rows = {r["field"]: r for r in contract.compare_schema(df).collect()}
    assert (rows["policy_state"]["unknown_symbols"], rows["policy_state"]["ok"]) == (1, 0)
    assert (rows["insured_sex"]["unknown_symbols"], rows["insured_sex"]["nulls"], rows["insured_sex"]["ok"]) == (0, 1, 0)


def test_rules_on_absent_columns_fail(spark):
    df = spark.createDataFrame([(1,), (200,)], "age int")
    rules = [quality.not_null("policy_number"), quality.between("age", 18, 100), quality.at_most_long("auto_make", 3)]
    rows = {r["rule"]: r for r in quality.suite(df, rules).collect()}
    assert [rows[r.name]["success"] for r in rules] == [0, 0, 0] and rows["policy_number_null"]["violations"] == 2
    assert all((r["suite_success"], r["evaluated"], r["successful"]) == (0, 3, 0) for r in rows.values())
    empty = spark.createDataFrame([], "other int")
    assert [r["success"] for r in quality.run_rules(empty, rules).collect()] == [0, 0, 0]
    assert "is missing" in quality.run_rules(empty, rules).first()["message"]
    assert quality.run_rules(empty, rules, absent_fails=False).count() == 0 and quality.run_rules(empty, []).count() == 0


def test_enrich_and_split(spark):
    df = spark.createDataFrame([("a", None, 1, "OH", 1.0, 1.0, None), ("b", None, 1, "XX", 1.0, 1.0, None)], RECORD)
    good, bad = contract.split_records(contract.enrich_records(df))
    assert good.first()["timestamp"] is not None and good.first()["errors"] == []
    assert bad.first()["timestamp"] is None and bad.first()["errors"] == ["Invalid policy_state: XX"]
