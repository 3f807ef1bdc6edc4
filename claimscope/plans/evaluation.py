"""Evaluation queries on the formula score, and the split and fold queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimscope.operators import evaluate, model, rates
from claimscope.plans.registry import define, query, rounded
from claimscope.schema import ENGINEERED_FEATURES, FINAL_COLUMNS
from claimscope.sources.tables import claims, relation

define("judged", "SELECT *, CASE WHEN probability >= 0.35 THEN 1 ELSE 0 END AS prediction FROM scored", ["scored"])

FEATURE_COUNT = len(FINAL_COLUMNS) - 2 + len(ENGINEERED_FEATURES)


def scored(spark, sf_dir):
    return relation(spark, sf_dir, "scored")


def judged(spark, sf_dir):
    return scored(spark, sf_dir).withColumn("prediction", evaluate.decision(F.col("probability")))


@query("eval_accuracy", f"SELECT {rounded('avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END)', 6)} AS accuracy FROM judged", ["judged"])
def eval_accuracy(spark, sf_dir):
    return evaluate.accuracy(judged(spark, sf_dir)).select(F.round("accuracy", 6).alias("accuracy"))


_AUC = """SELECT sum(pos * (below + 0.5 * neg))::DOUBLE / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) FROM (
  SELECT pos, neg, sum(neg) OVER (ORDER BY probability) - neg AS below FROM (
    SELECT probability, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM judged GROUP BY probability))"""


@query("eval_auc", f"SELECT {rounded('(' + _AUC + ')', 8)} AS auc", ["judged"])
def eval_auc(spark, sf_dir):
    return evaluate.auc(scored(spark, sf_dir)).select(F.round("auc", 8).alias("auc"))


@query("eval_confusion", """SELECT l.label, p.prediction, (SELECT count(*) FROM judged j WHERE j.label = l.label AND j.prediction = p.prediction) AS n
  FROM (VALUES (0), (1)) l(label), (VALUES (0), (1)) p(prediction)""", ["judged"])
def eval_confusion(spark, sf_dir):
    return evaluate.confusion(judged(spark, sf_dir))


define("class_figures", """SELECT c, tp / nullif(pp, 0)::DOUBLE AS p, tp / nullif(s, 0)::DOUBLE AS r, s FROM (
  SELECT c, (SELECT count(*) FROM judged WHERE label = c AND prediction = c)::DOUBLE AS tp,
    (SELECT count(*) FROM judged WHERE prediction = c) AS pp, (SELECT count(*) FROM judged WHERE label = c) AS s FROM (VALUES (0), (1)) v(c))""",
       ["judged"])
define("class_scores", """SELECT c, coalesce(p, 0) AS p, coalesce(r, 0) AS r, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f, s FROM class_figures""",
       ["class_figures"])
_R6 = {k: rounded(k, 6) for k in ("p", "r", "f")}


def _avg_line(name: str, form: str) -> str:
    p, r, f = (rounded(form.format(k), 6) for k in ("p", "r", "f"))
    return f"SELECT '{name}', {p}, {r}, {f}, CAST(sum(s) AS BIGINT) FROM class_scores"


_ACC = rounded("avg(CASE WHEN prediction = label THEN 1.0::DOUBLE ELSE 0.0 END)", 6)


@query("eval_class_report", f"""SELECT CAST(c AS VARCHAR) AS "class", {_R6['p']} AS "precision", {_R6['r']} AS recall, {_R6['f']} AS f1, s AS support
  FROM class_scores UNION ALL SELECT 'accuracy', {_ACC}, {_ACC}, {_ACC}, count(*) FROM judged
  UNION ALL {_avg_line('macro avg', 'avg({})')} UNION ALL {_avg_line('weighted avg', 'sum({0} * s) / sum(s)')}""", ["class_scores"])
def eval_class_report(spark, sf_dir):
    return evaluate.class_report(judged(spark, sf_dir))


_METRICS = f"""SELECT {rounded('avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END)', 3)} AS accuracy, count(*) AS total_samples,
  count(*) FILTER (label = 1) AS fraud_samples, count(*) FILTER (label = 0) AS legitimate_samples,
  {rounded('(' + _AUC + ')', 3)} AS auc_score, {FEATURE_COUNT} AS features_count FROM judged"""


@query("model_metrics", _METRICS, ["judged"])
def model_metrics(spark, sf_dir):
    return evaluate.model_metrics(judged(spark, sf_dir), FEATURE_COUNT)


@query("model_gate", f"""SELECT *, CASE WHEN reason IS NULL THEN 1 ELSE 0 END AS passed FROM (SELECT *,
  CASE WHEN accuracy < 0.70 THEN 'accuracy below 0.7' WHEN auc_score < 0.70 THEN 'AUC below 0.7' END AS reason FROM ({_METRICS}))""", ["judged"])
def model_gate(spark, sf_dir):
    return evaluate.gate(evaluate.model_metrics(judged(spark, sf_dir), FEATURE_COUNT))


@query("band_decision", "SELECT policy_number, probability, prediction FROM judged", ["judged"])
def band_decision(spark, sf_dir):
    return judged(spark, sf_dir).select("policy_number", "probability", "prediction")


@query("band_confidence", """SELECT policy_number, probability, CASE WHEN probability > 0.75 OR probability < 0.25 THEN 'high' ELSE 'medium' END AS confidence
  FROM scored""", ["scored"])
def band_confidence(spark, sf_dir):
    return scored(spark, sf_dir).select("policy_number", "probability", evaluate.confidence(F.col("probability")).alias("confidence"))


@query("band_risk", """SELECT policy_number, round_even(probability, 3) AS fraud_probability, CASE WHEN round_even(probability, 3) > 0.7 THEN 'HIGH'
  WHEN round_even(probability, 3) > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM scored""", ["scored"])
def band_risk(spark, sf_dir):
    p = F.col("probability")
    return scored(spark, sf_dir).select("policy_number", F.bround(p, 3).alias("fraud_probability"), evaluate.risk_level(p).alias("risk_level"))


@query("indicator_values", """SELECT policy_number, CASE WHEN bodily_injuries > 0 AND witnesses = 0 THEN 1 ELSE 0 END AS no_witness_injury,
  total_claim_amount / (policy_annual_premium + 1) AS claim_to_premium_ratio, incident_severity, total_claim_amount FROM claims""", ["claims"])
def indicator_values(spark, sf_dir):
    return claims(spark, sf_dir).select("policy_number", model.indicators().alias("key_features")).select("policy_number", "key_features.*")


define("hashed", """SELECT policy_number, incident_date, label,
  CAST(('0x' || substr(md5(policy_number || ':42'), 1, 13)) AS BIGINT)::DOUBLE / 4503599627370496.0 AS h FROM scored""", ["scored"])
define("hash_ranks", """SELECT label, h, row_number() OVER (PARTITION BY label ORDER BY h) - 1 AS rk, count(*) OVER (PARTITION BY label) AS n FROM hashed""",
       ["hashed"])


def _cut(p: str) -> str:
    return f"(SELECT max(r.h) FROM hash_ranks r WHERE r.label = s.label AND r.rk = floor((r.n - 1) * {p}))"


@query("split_stratified", f"SELECT policy_number, incident_date, label, CASE WHEN h <= {_cut('0.2::DOUBLE')} THEN 1 ELSE 0 END AS is_test FROM hashed s",
       ["hash_ranks"])
def split_stratified(spark, sf_dir):
    rows = scored(spark, sf_dir).select("policy_number", "incident_date", "label")
    return evaluate.stratified_split(rows, "label", "policy_number", 0.2, 42)


@query("fold_stratified", "SELECT policy_number, incident_date, label, " + " + ".join(
    f"CASE WHEN h > {_cut(f'{i / 5}::DOUBLE')} THEN 1 ELSE 0 END" for i in range(1, 5)) + " AS fold FROM hashed s", ["hash_ranks"])
def fold_stratified(spark, sf_dir):
    rows = scored(spark, sf_dir).select("policy_number", "incident_date", "label")
    return evaluate.stratified_folds(rows, "label", "policy_number", 5, 42)


@query("weight_imbalance", """SELECT count(*) FILTER (label = 0)::DOUBLE / count(*) FILTER (label = 1) AS positive_weight,
  1.3 * (count(*) FILTER (label = 0)::DOUBLE / count(*) FILTER (label = 1)) AS first_booster_weight,
  1.5 * (count(*) FILTER (label = 0)::DOUBLE / count(*) FILTER (label = 1)) AS second_booster_weight FROM scored""", ["scored"])
def weight_imbalance(spark, sf_dir):
    w = F.col("ratio")
    return rates.class_balance(scored(spark, sf_dir), "label").select(
        w.alias("positive_weight"), (F.lit(1.3) * w).alias("first_booster_weight"), (F.lit(1.5) * w).alias("second_booster_weight"))
