"""Aggregation, ranking and paging queries over the claims table."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimscope.functions.columns import label_rank
from claimscope.operators import clean, rates
from claimscope.plans.registry import define, query, quoted, rounded
from claimscope.schema import AGE_LABELS, FINAL_COLUMNS, TENURE_LABELS
from claimscope.sources.paging import PagedTable
from claimscope.sources.tables import claims, once, relation

_FR = "CAST(sum(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) AS BIGINT)"


def _rate(scale: int = 100, digits: int = 2) -> str:
    return rounded(f"{_FR} * {scale}.0 / count(*)", digits)


def _by(key: str, expr: str | None = None) -> str:
    return (f"SELECT {expr or key} AS {key}, count(*) AS total_claims, {_FR} AS fraud_count, {_rate()} AS fraud_rate "
            f"FROM claims GROUP BY ALL")


def _avg(column: str, digits: int = 2) -> str:
    return rounded(f"avg({column})", digits)


@query("agg_fraud_overall",
       f"SELECT count(*) AS total_claims, {_FR} AS fraud_count, {_rate()} AS fraud_rate_percent FROM claims", ["claims"])
def agg_fraud_overall(spark, sf_dir):
    return rates.fraud_rate(claims(spark, sf_dir), rate="fraud_rate_percent")


@query("agg_by_severity", _by("incident_severity"), ["claims"])
def agg_by_severity(spark, sf_dir):
    return rates.fraud_rate(claims(spark, sf_dir), ["incident_severity"]).orderBy(F.desc("fraud_rate"))


@query("agg_by_state", f"""SELECT policy_state, count(*) AS total_claims, {_FR} AS fraud_count,
  {_avg('total_claim_amount')} AS avg_claim_amount FROM claims GROUP BY policy_state""", ["claims"])
def agg_by_state(spark, sf_dir):
    extra = {"avg_claim_amount": rates.mean("total_claim_amount")}
    return rates.fraud_rate(claims(spark, sf_dir), ["policy_state"], extra=extra, rate=None).orderBy(F.desc("fraud_count"))


@query("agg_top_makes", f"""SELECT auto_make, count(*) AS total_claims, {_FR} AS fraud_count, {_rate()} AS fraud_rate
  FROM claims GROUP BY auto_make HAVING count(*) > 50 ORDER BY fraud_rate DESC, auto_make LIMIT 5""", ["claims"])
def agg_top_makes(spark, sf_dir):
    return rates.top_makes(claims(spark, sf_dir))


@query("agg_by_tenure", _by("tenure_group"), ["claims"])
def agg_by_tenure(spark, sf_dir):
    return rates.fraud_rate(claims(spark, sf_dir), ["tenure_group"]).orderBy(
        F.desc("fraud_rate"), label_rank(F.col("tenure_group"), TENURE_LABELS))


@query("agg_fraud_vs_legit", f"""SELECT is_fraud, count(*) AS claim_count, {_avg('total_claim_amount')} AS avg_claim_amount,
  {_avg('policy_annual_premium')} AS avg_premium, {_avg('months_as_customer')} AS avg_tenure_months
  FROM claims GROUP BY is_fraud""", ["claims"])
def agg_fraud_vs_legit(spark, sf_dir):
    return claims(spark, sf_dir).groupBy("is_fraud").agg(
        F.count("*").alias("claim_count"),
        rates.mean("total_claim_amount").alias("avg_claim_amount"),
        rates.mean("policy_annual_premium").alias("avg_premium"),
        rates.mean("months_as_customer").alias("avg_tenure_months"),
    )


@query("agg_by_witness", _by("witness_status", "CASE WHEN witnesses = 0 THEN 'No Witnesses' ELSE 'Has Witnesses' END"), ["claims"])
def agg_by_witness(spark, sf_dir):
    return rates.fraud_rate(claims(spark, sf_dir), [rates.witness_status()])


@query("agg_by_age_group", _by("age_group"), ["claims"])
def agg_by_age_group(spark, sf_dir):
    return rates.fraud_rate(claims(spark, sf_dir), ["age_group"]).orderBy(
        F.desc("fraud_rate"), label_rank(F.col("age_group"), AGE_LABELS))


@query("agg_by_incident_type", f"""SELECT incident_type, count(*) AS total_claims, {_FR} AS fraud_count,
  {_avg('total_claim_amount')} AS avg_claim_amount FROM claims GROUP BY incident_type""", ["claims"])
def agg_by_incident_type(spark, sf_dir):
    extra = {"avg_claim_amount": rates.mean("total_claim_amount")}
    return rates.fraud_rate(claims(spark, sf_dir), ["incident_type"], extra=extra, rate=None).orderBy(F.desc("fraud_count"))


@query("agg_by_injuries", _by("bodily_injuries"), ["claims"])
def agg_by_injuries(spark, sf_dir):
    return rates.fraud_rate(claims(spark, sf_dir), ["bodily_injuries"]).orderBy("bodily_injuries")


@query("agg_make_stats", f"""SELECT auto_make, count(*) AS claim_count, {_FR} AS fraud_count, {_rate(100, 1)} AS fraud_rate
  FROM claims GROUP BY auto_make""", ["claims"])
def agg_make_stats(spark, sf_dir):
    return rates.fraud_rate(claims(spark, sf_dir), ["auto_make"], digits=1, total="claim_count").orderBy(F.desc("fraud_rate"))


@query("agg_severity_type", f"""SELECT incident_severity, incident_type, count(*) AS claim_count, {_FR} AS fraud_count
  FROM claims GROUP BY ALL""", ["claims"])
def agg_severity_type(spark, sf_dir):
    return rates.fraud_rate(claims(spark, sf_dir), ["incident_severity", "incident_type"], total="claim_count", rate=None)


_LABEL = "CASE is_fraud WHEN 0 THEN 'Legitimate' WHEN 1 THEN 'Fraud' END AS fraud_label, count(*) AS claim_count FROM claims GROUP BY ALL"


@query("agg_severity_label", f"SELECT incident_severity, {_LABEL}", ["claims"])
def agg_severity_label(spark, sf_dir):
    return rates.label_counts(claims(spark, sf_dir), ["incident_severity"])


@query("agg_type_label", f"SELECT incident_type, {_LABEL}", ["claims"])
def agg_type_label(spark, sf_dir):
    return rates.label_counts(claims(spark, sf_dir), ["incident_type"])


@query("agg_label_distribution", f"SELECT {_LABEL}", ["claims"])
def agg_label_distribution(spark, sf_dir):
    return rates.label_counts(claims(spark, sf_dir))


@query("agg_kpis", f"""SELECT count(*) AS total_claims, {_FR} AS fraud_count, coalesce({_rate(100, 1)}, 0) AS fraud_rate,
  {_avg('total_claim_amount')} AS avg_claim_amount FROM claims""", ["claims"])
def agg_kpis(spark, sf_dir):
    return rates.kpis(claims(spark, sf_dir))


@query("agg_stats_endpoint", f"""SELECT count(*) AS total_claims, {_FR} AS fraud_count, {_rate(100, 1)} AS fraud_rate_percent,
  {_avg('total_claim_amount')} AS avg_claim_amount, {_avg('policy_annual_premium')} AS avg_premium FROM claims""", ["claims"])
def agg_stats_endpoint(spark, sf_dir):
    extra = {"avg_claim_amount": rates.mean("total_claim_amount"), "avg_premium": rates.mean("policy_annual_premium")}
    return rates.fraud_rate(claims(spark, sf_dir), digits=1, extra=extra, rate="fraud_rate_percent")


define("fraud_groups", f"""SELECT auto_make, incident_severity_clean AS incident_severity, age_group, tenure_group,
  count(*) AS total_claims, CAST(sum(is_fraud) AS BIGINT) AS fraud_count, {rounded('sum(is_fraud) * 1.0 / count(*)', 3)} AS fraud_rate,
  CAST(sum(CAST(total_claim_amount AS DECIMAL(30,8))) AS DOUBLE) / count(total_claim_amount) AS avg_claim_amount,
  CAST(sum(CAST(policy_annual_premium AS DECIMAL(30,8))) AS DOUBLE) / count(policy_annual_premium) AS avg_premium,
  {rounded('sum(total_claim_amount)', 4)} AS total_claim_value
  FROM stg_claims GROUP BY auto_make, incident_severity_clean, age_group, tenure_group""", ["stg_claims"])
_BAND = "CASE WHEN fraud_rate >= 0.2 THEN 'HIGH_RISK' WHEN fraud_rate >= 0.1 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS risk_category"
_RANK = """row_number() OVER (ORDER BY fraud_rate DESC, auto_make NULLS FIRST, incident_severity NULLS FIRST,
  age_group NULLS FIRST, tenure_group NULLS FIRST) AS fraud_rank"""


def _staged(spark, sf_dir):
    return clean.staging_view(claims(spark, sf_dir))


@query("mart_fraud_summary", f"SELECT *, {_BAND}, {_RANK} FROM fraud_groups", ["fraud_groups"])
def mart_fraud_summary(spark, sf_dir):
    return rates.fraud_summary(_staged(spark, sf_dir))


@query("win_fraud_rank", f"SELECT auto_make, incident_severity, age_group, tenure_group, fraud_rate, {_RANK} FROM fraud_groups",
       ["fraud_groups"])
def win_fraud_rank(spark, sf_dir):
    groups = rates.fraud_groups(_staged(spark, sf_dir)).select(*rates.MART_KEYS, "fraud_rate")
    return rates.rank_rows(groups, "fraud_rate", rates.MART_KEYS, "fraud_rank")


@query("band_mart_risk", f"SELECT auto_make, incident_severity, age_group, tenure_group, fraud_rate, {_BAND} FROM fraud_groups",
       ["fraud_groups"])
def band_mart_risk(spark, sf_dir):
    groups = rates.fraud_groups(_staged(spark, sf_dir)).select(*rates.MART_KEYS, "fraud_rate")
    return groups.withColumn("risk_category", rates.risk_band(F.col("fraud_rate")))


@query("hist_claim_amount", """SELECT CAST(least(floor(30 * (total_claim_amount - lo) / (hi - lo)) + 1, 30) AS INTEGER) AS bin,
  is_fraud, count(*) AS n
  FROM claims, (SELECT min(total_claim_amount) AS lo, max(total_claim_amount) AS hi FROM claims) GROUP BY ALL""", ["claims"])
def hist_claim_amount(spark, sf_dir):
    return rates.histogram(claims(spark, sf_dir), "total_claim_amount", 30, ["is_fraud"])


@query("distinct_filter_values", """SELECT DISTINCT 'incident_severity' AS filter_name, incident_severity AS value FROM claims
  UNION ALL SELECT DISTINCT 'auto_make', auto_make FROM claims""", ["claims"])
def distinct_filter_values(spark, sf_dir):
    return rates.distinct_values(claims(spark, sf_dir), ["incident_severity", "auto_make"])


@query("class_balance", """SELECT count(*) FILTER (is_fraud = 1) AS positives, count(*) FILTER (is_fraud = 0) AS negatives,
  count(*) AS total, count(*) FILTER (is_fraud = 0)::DOUBLE / count(*) FILTER (is_fraud = 1) AS ratio FROM claims""", ["claims"])
def class_balance(spark, sf_dir):
    return rates.class_balance(claims(spark, sf_dir))


@query("restore_check", f"""SELECT count(*) AS claims_count, coalesce(CAST(sum(is_fraud) AS BIGINT), 0) AS fraud_count,
  count(*) - coalesce(CAST(sum(is_fraud) AS BIGINT), 0) AS legitimate_count, {rounded('sum(is_fraud) * 100.0 / count(*)', 1)} AS fraud_rate
  FROM claims""", ["claims"])
def restore_check(spark, sf_dir):
    return rates.restore_check(claims(spark, sf_dir))


_PAGE_ORDER = ["policy_number", "total_claim_amount", *[c for c in FINAL_COLUMNS if c not in ("policy_number", "total_claim_amount")]]


@query("page_claims", "SELECT " + ", ".join(quoted(c) for c in FINAL_COLUMNS) + " FROM claims WHERE is_fraud = 1 ORDER BY "
       + ", ".join(f"{quoted(c)} NULLS FIRST" for c in _PAGE_ORDER) + " LIMIT 100 OFFSET 200", ["claims"])
def page_claims(spark, sf_dir):
    return rates.page(clean.fraud_only(claims(spark, sf_dir)), ["policy_number", "total_claim_amount"], 100, 200)


_PAGE_BY = ", ".join(f"{quoted(c)} NULLS FIRST" for c in _PAGE_ORDER)


@query("page_claims_seek", "WITH n AS (SELECT *, row_number() OVER (ORDER BY " + _PAGE_BY + """) - 1 AS _place, count(*) OVER () AS _all FROM claims),
  f AS (SELECT min(_place) AS at FROM n WHERE policy_number >= 'Pol00000500')
  SELECT 'seek' AS page, """ + ", ".join(f"n.{quoted(c)}" for c in FINAL_COLUMNS) + """, _place FROM n, f
  WHERE _place BETWEEN f.at AND f.at + 49 UNION ALL SELECT 'deep', """ + ", ".join(quoted(c) for c in FINAL_COLUMNS) + """, _place FROM n
  WHERE _place >= _all * 9 // 10 AND _place < _all * 9 // 10 + 100""", ["claims"])
def page_claims_seek(spark, sf_dir):
    """From a table kept in ranges: the page that lies nine tenths behind, and the page from a policy number on."""
    kept = PagedTable(spark, once(spark, sf_dir, "paged_claims", lambda path: PagedTable.write(claims(spark, sf_dir), path, ["policy_number", "total_claim_amount"])))
    deep = kept.at(kept.count() * 9 // 10, 100).withColumn("page", F.lit("deep"))
    return deep.unionByName(kept.at(kept.find("Pol00000500"), 50).withColumn("page", F.lit("seek")))


@query("page_predictions", """SELECT policy_number, incident_date, probability, (SELECT count(*) FROM scored WHERE probability >= 0.35) AS matching
  FROM scored WHERE probability >= 0.35 ORDER BY incident_date, policy_number, probability LIMIT 50""", ["scored"])
def page_predictions(spark, sf_dir):
    hits = relation(spark, sf_dir, "scored").filter("probability >= 0.35")
    shown = rates.page(hits, ["incident_date", "policy_number", "probability"], 50, most=100)
    return shown.select("policy_number", "incident_date", "probability",
                        hits.select(F.count("*")).scalar().alias("matching"))


@query("agg_batch_summary", f"""SELECT count(*) AS total_predictions, count(*) FILTER (probability >= 0.35) AS fraud_count,
  count(*) FILTER (probability < 0.35) AS legitimate_count,
  {rounded('count(*) FILTER (probability >= 0.35) * 100.0 / count(*)', 1)} AS fraud_rate FROM scored""", ["scored"])
def agg_batch_summary(spark, sf_dir):
    scored = relation(spark, sf_dir, "scored")
    return rates.batch_summary(scored.withColumn("prediction", (F.col("probability") >= 0.35).cast("int")))
