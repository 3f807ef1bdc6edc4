"""Cleaning and projection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimscope.functions.columns import col
from claimscope.operators import clean
from claimscope.plans.registry import query, quoted, title_sql
from claimscope.schema import (
    BROWSER_COLUMNS, FINAL_COLUMNS, NUMERIC_COLUMNS, READ_NUMERIC, STRING_COLUMNS,
)
from claimscope.sources.tables import claims, relation

_RAW = [c for c in FINAL_COLUMNS if c in NUMERIC_COLUMNS or c in STRING_COLUMNS]
_RAW_LIST = ", ".join(quoted(c) for c in _RAW)
_CLEAN_LIST = ", ".join(quoted(c) for c in FINAL_COLUMNS)


def raw(spark, sf_dir):
    return relation(spark, sf_dir, "claims_raw")


@query("clean_drop_junk", f"SELECT {_RAW_LIST}, fraud_reported, incident_date FROM claims_raw", ["claims_raw"])
def clean_drop_junk(spark, sf_dir):
    return clean.drop_junk(raw(spark, sf_dir))


@query(
    "clean_fill_median",
    "SELECT policy_number, " + ", ".join(quoted(c) for c in NUMERIC_COLUMNS) + " FROM filled",
    ["filled"],
)
def clean_fill_median(spark, sf_dir):
    return clean.fill_median(raw(spark, sf_dir).select("policy_number", *[col(c) for c in NUMERIC_COLUMNS]))


@query(
    "clean_fill_unknown",
    "SELECT incident_date, " + ", ".join(quoted(c) for c in [*STRING_COLUMNS, "fraud_reported"]) + " FROM filled",
    ["filled"],
)
def clean_fill_unknown(spark, sf_dir):
    df = raw(spark, sf_dir).select("incident_date", *STRING_COLUMNS, "fraud_reported")
    return clean.fill_unknown(df)


@query(
    "clean_title_case",
    "SELECT " + ", ".join(f"{title_sql(c)} AS {c}" for c in STRING_COLUMNS) + ", fraud_reported FROM claims_raw",
    ["claims_raw"],
)
def clean_title_case(spark, sf_dir):
    return clean.title_text(raw(spark, sf_dir).select(*STRING_COLUMNS, "fraud_reported"))


@query("derive_has_claim",
       "SELECT policy_number, total_claim_amount, CASE WHEN total_claim_amount > 0 THEN 1 ELSE 0 END AS has_claim FROM claims_raw",
       ["claims_raw"])
def derive_has_claim(spark, sf_dir):
    return clean.derive_has_claim(raw(spark, sf_dir).select("policy_number", "total_claim_amount"))


@query("derive_age_group", """SELECT policy_number, age,
  CASE WHEN age > 0 AND age <= 25 THEN '18-25' WHEN age > 25 AND age <= 35 THEN '26-35' WHEN age > 35 AND age <= 45 THEN '36-45'
       WHEN age > 45 AND age <= 55 THEN '46-55' WHEN age > 55 AND age <= 65 THEN '56-65' WHEN age > 65 AND age <= 100 THEN '65+' END AS age_group
  FROM claims_raw""", ["claims_raw"])
def derive_age_group(spark, sf_dir):
    return clean.derive_age_group(raw(spark, sf_dir).select("policy_number", "age"))


@query("derive_tenure_group", """SELECT policy_number, months_as_customer,
  CASE WHEN months_as_customer > 0 AND months_as_customer <= 12 THEN '0-1yr' WHEN months_as_customer > 12 AND months_as_customer <= 24 THEN '1-2yr'
       WHEN months_as_customer > 24 AND months_as_customer <= 48 THEN '2-4yr' WHEN months_as_customer > 48 AND months_as_customer <= 120 THEN '4-10yr'
       WHEN months_as_customer > 120 AND months_as_customer <= 500 THEN '10yr+' END AS tenure_group
  FROM claims_raw""", ["claims_raw"])
def derive_tenure_group(spark, sf_dir):
    return clean.derive_tenure_group(raw(spark, sf_dir).select("policy_number", "months_as_customer"))


@query("encode_target",
       "SELECT policy_number, fraud_reported, CASE WHEN fraud_reported = 'Y' THEN 1 ELSE 0 END AS is_fraud FROM claims_raw",
       ["claims_raw"])
def encode_target(spark, sf_dir):
    return clean.encode_target(raw(spark, sf_dir).select("policy_number", "fraud_reported"))


@query("project_final", f"SELECT {_RAW_LIST} FROM claims_raw", ["claims_raw"])
def project_final(spark, sf_dir):
    return clean.project_final(raw(spark, sf_dir))


@query("transform_claims", f"SELECT {_CLEAN_LIST} FROM claims", ["claims"])
def transform_claims(spark, sf_dir):
    return clean.transform_claims(raw(spark, sf_dir))


@query("coerce_numeric",
       """SELECT policy_number, TRY_CAST(policy_csl AS DOUBLE) AS policy_csl,
          TRY_CAST(CASE WHEN incident_hour_of_the_day >= 12 THEN CAST(age AS VARCHAR) ELSE incident_severity END AS DOUBLE) AS mixed
          FROM claims_raw""", ["claims_raw"])
def coerce_numeric(spark, sf_dir):
    mixed = F.when(F.col("incident_hour_of_the_day") >= 12, F.col("age").cast("string")).otherwise(
        F.col("incident_severity"))
    df = raw(spark, sf_dir).select("policy_number", "policy_csl", mixed.alias("mixed"))
    return clean.coerce_numeric(df, ["policy_csl", "mixed"])


@query("scan_table", "SELECT " + ", ".join(quoted(c) for c in FINAL_COLUMNS) + " FROM claims", ["claims"])
def scan_table(spark, sf_dir):
    return clean.coerce_numeric(claims(spark, sf_dir), READ_NUMERIC)


@query("stg_claims", "SELECT * FROM stg_claims", ["stg_claims"])
def stg_claims(spark, sf_dir):
    return clean.staging_view(claims(spark, sf_dir))


@query("filter_fraud_only", f"SELECT {_CLEAN_LIST} FROM claims WHERE is_fraud = 1", ["claims"])
def filter_fraud_only(spark, sf_dir):
    return clean.fraud_only(claims(spark, sf_dir))


@query("claims_browser", """SELECT policy_number, auto_make, incident_type, incident_severity, total_claim_amount,
  policy_annual_premium, is_fraud, CAST(count(*) OVER () AS BIGINT) AS shown, (SELECT count(*) FROM claims) AS total
  FROM claims WHERE incident_severity = 'Minor Damage' AND is_fraud = 1 AND auto_make = 'Bmw'""", ["claims"])
def claims_browser(spark, sf_dir):
    df = claims(spark, sf_dir)
    shown = clean.browse(df, "Minor Damage", "Fraud Only", "Bmw", BROWSER_COLUMNS)
    return shown.withColumns({
        "shown": shown.select(F.count("*")).scalar(),
        "total": df.select(F.count("*")).scalar(),
    })


@query("drop_null_pairs", """SELECT months_as_customer, injury_claim, fraud_reported FROM claims_raw
  WHERE months_as_customer IS NOT NULL AND injury_claim IS NOT NULL""", ["claims_raw"])
def drop_null_pairs(spark, sf_dir):
    return clean.drop_null_pairs(raw(spark, sf_dir), "months_as_customer", "injury_claim", ["fraud_reported"])


@query("label_map", """SELECT policy_number, is_fraud,
  CASE is_fraud WHEN 0 THEN 'Legitimate' WHEN 1 THEN 'Fraud' END AS fraud_label FROM claims""", ["claims"])
def label_map(spark, sf_dir):
    return claims(spark, sf_dir).select(
        "policy_number", "is_fraud", clean.fraud_label(F.col("is_fraud")).alias("fraud_label"))


@query("select_features",
       "SELECT " + ", ".join(quoted(c) for c in FINAL_COLUMNS if c not in ("policy_number", "is_fraud"))
       + ", is_fraud AS target FROM claims", ["claims"])
def select_features(spark, sf_dir):
    df = claims(spark, sf_dir)
    return df.drop("policy_number").withColumnRenamed("is_fraud", "target")
