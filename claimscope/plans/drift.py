"""Drift and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from claimscope.operators import drift, evaluate
from claimscope.plans.registry import define, query, quoted, rounded
from claimscope.schema import CLEAN_SCHEMA, NUMERIC_COLUMNS, RAW_SCHEMA
from claimscope.sources.tables import claims, relation

_TYPES = {f.name: f.dataType for f in RAW_SCHEMA}
_NUMERIC = [c for c, t in _TYPES.items() if isinstance(t, NumericType)]
_TEXT = [c for c, t in _TYPES.items() if isinstance(t, StringType) and c != "policy_number"]
_PROFILED_TEXT = [f.name for f in CLEAN_SCHEMA if isinstance(f.dataType, StringType) and f.name != "policy_number"]


#: SQL has the asymptotic p-value only, so the queries count exactly up to this size, which none of their tables falls below.
ASYMPTOTIC = 200


def sides(spark, sf_dir):
    return relation(spark, sf_dir, "drift_ref"), relation(spark, sf_dir, "drift_new")


def r2(names, digits=2):
    return [F.round(n, digits).alias(n) for n in names]


@query("profile_numeric", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {rounded(f'avg({quoted(c)})', 2)} AS mean, {rounded(f'stddev_samp({quoted(c)})', 2)} AS std,
    min({quoted(c)})::DOUBLE AS "min", max({quoted(c)})::DOUBLE AS "max", """ + ", ".join(
        rounded(f"quantile_cont(CAST({quoted(c)} AS DOUBLE), {p})", 6) + f" AS q{n}" for n, p in ((25, 0.25), (50, 0.5), (75, 0.75)))
    + " FROM claims_raw" for c in NUMERIC_COLUMNS), ["claims_raw"])
def profile_numeric(spark, sf_dir):
    out = drift.profile_numeric(relation(spark, sf_dir, "claims_raw"), NUMERIC_COLUMNS)
    return out.select("feature", *r2(["mean", "std"]), "min", "max", *r2(["q25", "q50", "q75"], 6))


@query("profile_categorical", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {c} AS value, {rounded(f'count(*)::DOUBLE / (SELECT count({c}) FROM claims)', 8)} AS share
    FROM claims WHERE {c} IS NOT NULL GROUP BY {c}""" for c in _PROFILED_TEXT), ["claims"])
def profile_categorical(spark, sf_dir):
    out = drift.profile_categorical(claims(spark, sf_dir), _PROFILED_TEXT)
    return out.select("feature", "value", *r2(["share"], 8))


def _psi_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, sum((n - r) * ln(n / r)) AS psi FROM (
      SELECT b, CASE WHEN r = 0 THEN 0.0001 ELSE r END AS r, CASE WHEN n = 0 THEN 0.0001 ELSE n END AS n FROM (
        SELECT b, (SELECT count(*) FROM ref_bins WHERE feature = '{c}' AND bin = b)::DOUBLE / (SELECT count(*) FROM drift_ref) AS r,
               (SELECT count(*) FROM new_bins WHERE feature = '{c}' AND bin = b)::DOUBLE / (SELECT count(*) FROM drift_new) AS n
        FROM range(10) t(b)))"""


define("psi_edges", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, quantile_cont({quoted(c)}::DOUBLE, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM drift_ref" for c in _NUMERIC),
       ["drift_ref"])
for _side in ("ref", "new"):
    define(f"{_side}_bins", " UNION ALL ".join(
        f"SELECT '{c}' AS feature, len(list_filter((SELECT edges FROM psi_edges WHERE feature = '{c}'), lambda e: e <= {quoted(c)})) AS bin "
        f"FROM drift_{_side} WHERE {quoted(c)} IS NOT NULL" for c in _NUMERIC), ["psi_edges", f"drift_{_side}"])
define("psi_values", " UNION ALL ".join(_psi_sql(c) for c in _NUMERIC), ["ref_bins", "new_bins"])


@query("drift_psi", f"SELECT feature, {rounded('psi', 6)} AS psi FROM psi_values", ["psi_values"])
def drift_psi(spark, sf_dir):
    return drift.psi(*sides(spark, sf_dir)).select("feature", *r2(["psi"], 6))


def _ks_sql(c: str) -> str:
    q = quoted(c)
    return f"""SELECT '{c}' AS feature, max(abs(f1 - f2)) AS d, max(m) AS m, max(n) AS n FROM (
      SELECT sum(r) OVER (ORDER BY v) / m AS f1, sum(w) OVER (ORDER BY v) / n AS f2, m, n FROM (
        SELECT v, sum(r)::DOUBLE AS r, sum(w)::DOUBLE AS w, (SELECT count({q}) FROM drift_ref)::DOUBLE AS m, (SELECT count({q}) FROM drift_new)::DOUBLE AS n
        FROM (SELECT {q}::DOUBLE AS v, 1 AS r, 0 AS w FROM drift_ref WHERE {q} IS NOT NULL
              UNION ALL SELECT {q}::DOUBLE, 0, 1 FROM drift_new WHERE {q} IS NOT NULL) GROUP BY v))"""


define("ks_stats", " UNION ALL ".join(_ks_sql(c) for c in _NUMERIC), ["drift_ref", "drift_new"])
define("ks_values", """SELECT feature, d AS ks_statistic, CASE WHEN z < 0.2 THEN 1.0 ELSE least(greatest(
  list_sum([CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * z * z) for k in range(1, 101)]), 0.0), 1.0) END AS ks_pvalue
  FROM (SELECT *, d * sqrt(m * n / (m + n)) AS z FROM ks_stats)""", ["ks_stats"])


@query("drift_ks", f"SELECT feature, {rounded('ks_statistic', 8)} AS ks_statistic, {rounded('ks_pvalue', 6)} AS ks_pvalue FROM ks_values", ["ks_values"])
def drift_ks(spark, sf_dir):
    return drift.ks(*sides(spark, sf_dir), exact_below=ASYMPTOTIC).select("feature", *r2(["ks_statistic"], 8), *r2(["ks_pvalue"], 6))


def _shares(c: str) -> str:
    one = "SELECT {c} AS v, count(*)::DOUBLE / (SELECT count({c}) FROM drift_{s}) AS p FROM drift_{s} WHERE {c} IS NOT NULL GROUP BY {c}"
    return f"""SELECT '{c}' AS feature, coalesce(r.v, n.v) AS value, coalesce(r.p, 0) AS ref_share, coalesce(n.p, 0) AS new_share
      FROM ({one.format(c=c, s='ref')}) r FULL JOIN ({one.format(c=c, s='new')}) n ON r.v = n.v"""


define("category_shares", " UNION ALL ".join(_shares(c) for c in _TEXT), ["drift_ref", "drift_new"])


@query("join_category_align", f"SELECT feature, value, {rounded('ref_share', 8)} AS ref_share, {rounded('new_share', 8)} AS new_share FROM category_shares",
       ["category_shares"])
def join_category_align(spark, sf_dir):
    return drift.align_categories(*sides(spark, sf_dir)).select("feature", "value", *r2(["ref_share", "new_share"], 8))


define("chi2_values", """SELECT feature, x AS chi2_statistic, df, CASE WHEN df < 1 THEN NULL WHEN x = 'inf'::DOUBLE THEN 0.0 WHEN x <= 0 THEN 1.0
  ELSE greatest(1 - list_sum([exp(-x / 2 + (df / 2 + i) * ln(x / 2) - lgamma(df / 2 + i + 1)) for i in range(0, 200)]), 0.0) END AS chi2_pvalue
  FROM (SELECT feature, sum(CASE WHEN ref_share = 0 AND new_share > 0 THEN 'inf'::DOUBLE ELSE (new_share - ref_share) ** 2 / ref_share END) AS x,
        CAST(count(*) - 1 AS INTEGER) AS df FROM category_shares GROUP BY feature)""", ["category_shares"])


@query("drift_chi2", "SELECT feature, round(chi2_statistic, 8) AS chi2_statistic, df, round(chi2_pvalue, 6) AS chi2_pvalue FROM chi2_values", ["chi2_values"])
def drift_chi2(spark, sf_dir):
    return drift.chi_square(drift.align_categories(*sides(spark, sf_dir))).select(
        "feature", *r2(["chi2_statistic"], 8), "df", *r2(["chi2_pvalue"], 6))


define("drift_features", """SELECT p.feature, psi, ks_statistic, ks_pvalue, NULL::DOUBLE AS chi2_statistic, NULL::DOUBLE AS chi2_pvalue,
  CASE WHEN psi > 0.05 OR ks_pvalue < 0.05 THEN 1 ELSE 0 END AS drifted FROM psi_values p JOIN ks_values k ON p.feature = k.feature
  UNION ALL SELECT feature, NULL, NULL, NULL, chi2_statistic, chi2_pvalue, CASE WHEN chi2_pvalue < 0.05 THEN 1 ELSE 0 END FROM chi2_values""",
       ["psi_values", "ks_values", "chi2_values"])


@query("drift_numeric_flag", f"""SELECT feature, {rounded('psi', 6)} AS psi, {rounded('ks_pvalue', 6)} AS ks_pvalue, drifted FROM drift_features
  WHERE psi IS NOT NULL AND drifted = 1""", ["drift_features"])
def drift_numeric_flag(spark, sf_dir):
    return drift.feature_drift(*sides(spark, sf_dir), text=False, exact_below=ASYMPTOTIC).filter("drifted = 1").select(
        "feature", *r2(["psi", "ks_pvalue"], 6), "drifted")


@query("drift_categorical_flag", """SELECT feature, round(chi2_statistic, 8) AS chi2_statistic, round(chi2_pvalue, 6) AS chi2_pvalue, drifted
  FROM drift_features WHERE psi IS NULL AND drifted = 1""", ["drift_features"])
def drift_categorical_flag(spark, sf_dir):
    return drift.feature_drift(*sides(spark, sf_dir), numeric=False).filter("drifted = 1").select(
        "feature", *r2(["chi2_statistic"], 8), *r2(["chi2_pvalue"], 6), "drifted")


_SEVERITY = "CASE WHEN {0} > 0.25 THEN 'critical' WHEN {0} > 0.15 THEN 'high' WHEN {0} > 0.05 THEN 'moderate' ELSE 'none' END"
define("drift_total", f"""SELECT drifted_features, overall_drift, {_SEVERITY.format('overall_drift')} AS severity FROM (
  SELECT count(*) FILTER (drifted = 1) AS drifted_features, coalesce(avg(coalesce(psi, 0)) FILTER (drifted = 1), 0) AS overall_drift
  FROM drift_features)""", ["drift_features"])


@query("drift_overall", f"SELECT drifted_features, {rounded('overall_drift', 6)} AS overall_drift, severity FROM drift_total", ["drift_total"])
def drift_overall(spark, sf_dir):
    return drift.overall(drift.feature_drift(*sides(spark, sf_dir), exact_below=ASYMPTOTIC)).select("drifted_features", *r2(["overall_drift"], 6), "severity")


_CUT = "TIMESTAMP '1998-07-01 00:00:00'"
define("prediction_drift", f"""SELECT *, abs(current_fraud_rate - reference_fraud_rate) AS fraud_rate_change, abs(current_avg_probability - 0.24) AS probability_change FROM (
  SELECT (SELECT avg(label::DOUBLE) FROM scored WHERE incident_date < {_CUT}) AS reference_fraud_rate,
    avg(CASE WHEN probability >= 0.35 THEN 1.0::DOUBLE ELSE 0.0 END) AS current_fraud_rate, avg(probability) AS current_avg_probability,
    0.24::DOUBLE AS reference_avg_probability FROM scored WHERE incident_date >= {_CUT})""", ["scored"])
_PREDICTION = ["reference_fraud_rate", "current_fraud_rate", "current_avg_probability", "reference_avg_probability",
               "fraud_rate_change", "probability_change"]
_DETECTED = "CASE WHEN fraud_rate_change > 0.10 OR probability_change > 0.1 THEN 1 ELSE 0 END"


def _prediction(spark, sf_dir):
    rows = relation(spark, sf_dir, "scored")
    early = F.col("incident_date") < F.expr("TIMESTAMP_NTZ '1998-07-01 00:00:00'")
    current = rows.filter(~early).withColumn("prediction", evaluate.decision(F.col("probability")))
    return drift.prediction_drift(rows.filter(early).select(F.col("label").alias("is_fraud")), current)


@query("drift_prediction", "SELECT " + ", ".join(f"{rounded(c, 8)} AS {c}" for c in _PREDICTION) + f", {_DETECTED} AS drift_detected, "
       "CASE WHEN fraud_rate_change > 0.15 THEN 'critical' WHEN fraud_rate_change > 0.10 THEN 'high' ELSE 'none' END AS severity FROM prediction_drift",
       ["prediction_drift"])
def drift_prediction(spark, sf_dir):
    return _prediction(spark, sf_dir).select(*r2(_PREDICTION, 8), "drift_detected", "severity")


_ADVICE = "CASE severity " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in drift.RECOMMENDATIONS.items()) + " ELSE 'Unknown' END"


@query("drift_recommend", f"SELECT checked_at, severity, {_ADVICE} AS recommendation FROM drift_log", ["drift_log"])
def drift_recommend(spark, sf_dir):
    return relation(spark, sf_dir, "drift_log").select(
        "checked_at", "severity", drift.recommendation(F.col("severity")).alias("recommendation"))


_TREND = f"""SELECT count(*) AS checks, CASE WHEN max_by(overall_drift, checked_at) > min_by(overall_drift, checked_at) THEN 1 ELSE 0 END AS increasing,
  {rounded('avg(overall_drift)', 8)} AS mean_drift, {rounded('max(overall_drift)', 8)} AS max_drift FROM drift_log HAVING count(*) >= 2"""


@query("drift_trend", _TREND, ["drift_log"])
def drift_trend(spark, sf_dir):
    return drift.trend(relation(spark, sf_dir, "drift_log")).select("checks", "increasing", *r2(["mean_drift", "max_drift"], 8))


@query("drift_report", f"""SELECT l.checked_at, {rounded('l.overall_drift', 8)} AS overall_drift, l.severity, t.checks AS total_checks, t.increasing,
  t.mean_drift, t.max_drift, {_ADVICE} AS recommendation FROM (SELECT * FROM drift_log ORDER BY checked_at DESC LIMIT 1) l, ({_TREND}) t""", ["drift_log"])
def drift_report(spark, sf_dir):
    out = drift.report(relation(spark, sf_dir, "drift_log"))
    return out.select("checked_at", *r2(["overall_drift"], 8), "severity", "total_checks", "increasing",
                      *r2(["mean_drift", "max_drift"], 8), "recommendation")


@query("drift_action", f"""SELECT data_severity, prediction_drift, CASE WHEN data_severity IN ('moderate', 'high', 'critical') OR prediction_drift = 1
  THEN 1 ELSE 0 END AS action_required FROM (SELECT severity AS data_severity, (SELECT {_DETECTED} FROM prediction_drift) AS prediction_drift FROM drift_total)""",
       ["drift_total", "prediction_drift"])
def drift_action(spark, sf_dir):
    return drift.action(drift.overall(drift.feature_drift(*sides(spark, sf_dir), exact_below=ASYMPTOTIC)), _prediction(spark, sf_dir))
