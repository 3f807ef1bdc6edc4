"""Features, evaluation, drift and the feature table on small frames with known answers."""

from __future__ import annotations

import math
import os

import pytest
from pyspark.sql import functions as F

from claimscope import session
from claimscope.functions.special import chi_square_pvalue, exact_ks_pvalue, kolmogorov_pvalue
from claimscope.operators import drift, evaluate, feature_table, features, model, rates, runlog, sampling
from claimscope.sources import tables
from claimscope.sources.tables import claims

LOW_RISK = (24, 35, 1200.0, 5000.0, 2, 0)
HIGH_RISK = (3, 25, 800.0, 15000.0, 0, 2)
CLAIM = "months_as_customer int, age int, policy_annual_premium double, total_claim_amount double, witnesses int, bodily_injuries int"


def test_features_of_known_claims(spark):
    rows = features.feature_rows(spark.createDataFrame([LOW_RISK, HIGH_RISK], CLAIM)).orderBy("claim_to_premium_ratio").collect()
    low, high = rows
    assert low["claim_to_premium_ratio"] == 5000 / 1201 and high["claim_to_premium_ratio"] == 15000 / 801
    assert (low["no_witness_injury"], high["no_witness_injury"]) == (0, 1)
    assert (low["is_new_customer"], high["is_new_customer"]) == (0, 1)
    assert low["vehicle_property_ratio"] == 0.0 and low["complex_no_witness"] == 0
    assert high["tenure_age_ratio"] == 3 / 301 and high["_claim_data"]["age"] == 25


def test_labels(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("é",), ("POL000000002",), ("POL000000001",)], "t string")
    dictionary = features.fit_labels(df, ["t"])
    want = {v: i for i, v in enumerate(sorted(["b", "a", "nan", "é", "POL000000002", "POL000000001"]))}
    assert {r["value"]: r["code"] for r in dictionary.collect()} == want
    new = spark.createDataFrame([("é",), ("zz",), (None,)], "t string")
    assert sorted(r[0] for r in features.encode_labels(new, dictionary, ["t"]).collect()) == sorted([want["é"], 0, want["nan"]])


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, probability double").withColumn("prediction", evaluate.decision(F.col("probability")))


def test_auc(spark):
    rows = [(i % 3 == 0, ((i * 37) % 100) / 100) for i in range(300)]
    rows = [(int(a), b) for a, b in rows]
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert evaluate.auc(scored(spark, rows)).first()[0] == pytest.approx(want, abs=1e-12)
    assert evaluate.auc(scored(spark, [(0, 0.1), (1, 0.9)])).first()[0] == 1.0
    assert evaluate.auc(scored(spark, [(0, 0.1), (0, 0.9)])).first()[0] is None


def test_confusion_and_report(spark):
    df = scored(spark, [(0, 0.1), (0, 0.9), (1, 0.9), (1, 0.9)])
    assert {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion(df).collect()} == {(0, 0): 1, (0, 1): 1, (1, 0): 0, (1, 1): 2}
    report = {r["class"]: r for r in evaluate.class_report(df).collect()}
    assert report["1"]["precision"] == pytest.approx(2 / 3, abs=1e-6) and report["0"]["recall"] == 0.5
    assert report["accuracy"]["f1"] == 0.75 and report["weighted avg"]["support"] == 4


def test_single_class_report(spark):
    report = {r["class"]: r for r in evaluate.class_report(scored(spark, [(0, 0.1)])).collect()}
    assert report["1"]["precision"] == 0.0 and report["1"]["support"] == 0 and report["0"]["f1"] == 1.0


def test_bands(spark):
    ps = [0.0, 0.2499, 0.25, 0.3, 0.3004, 0.3006, 0.35, 0.7, 0.7004, 0.7006, 0.75, 0.76]
    rows = evaluate.decide(spark.createDataFrame([(p,) for p in ps], "probability double")).orderBy("probability").collect()
    assert [r["prediction"] for r in rows] == [int(p >= 0.35) for p in ps]
    assert [r["confidence"] for r in rows] == ["high" if p > 0.75 or p < 0.25 else "medium" for p in ps]
    assert [r["risk_level"] for r in rows] == ["HIGH" if round(p, 3) > 0.7 else "MEDIUM" if round(p, 3) > 0.3 else "LOW" for p in ps]


def test_split_and_folds_keep_class_shares(spark):
    df = spark.createDataFrame([(f"P{i}", int(i % 4 == 0)) for i in range(4000)], "k string, y int")
    n = {(r["y"], r["is_test"]): r["count"] for r in evaluate.stratified_split(df, "y", "k").groupBy("y", "is_test").count().collect()}
    assert abs(n[1, 1] - 200) <= 1 and abs(n[0, 1] - 600) <= 1
    folds = {(r["y"], r["fold"]): r["count"] for r in evaluate.stratified_folds(df, "y", "k").groupBy("y", "fold").count().collect()}
    assert len(folds) == 10 and all(abs(c - (200 if y else 600)) <= 2 for (y, _), c in folds.items())


def test_gate(spark):
    rows = evaluate.gate(spark.createDataFrame([(0.9, 0.69), (0.69, 0.9), (0.7, 0.7)], "accuracy double, auc_score double"))
    assert [r["passed"] for r in rows.collect()] == [0, 0, 1]
    with pytest.raises(ValueError, match="AUC"):
        evaluate.require_gate(rows)


def test_pvalues(spark):
    one = spark.range(1)
    known = [(3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05), (0.0, 3, 1.0), (5.0, 2, math.exp(-2.5)), (900.0, 4, 0.0), (60.0, 50, 0.15724)]
    for x, df, p in known:
        got = one.select(chi_square_pvalue(F.lit(x), F.lit(df))).first()[0]
        assert got == pytest.approx(p, abs=1e-5)
    got = one.select(kolmogorov_pvalue(F.lit(1.3580986 / math.sqrt(500)), F.lit(1000), F.lit(1000))).first()[0]
    assert got == pytest.approx(0.05, abs=1e-4)
    assert one.select(kolmogorov_pvalue(F.lit(0.0), F.lit(10), F.lit(10))).first()[0] == 1.0


def test_drift_against_itself_and_a_shift(spark):
    rows = [(float(i % 97), "abc"[i % 3], f"k{i}") for i in range(2000)]
    ref = spark.createDataFrame(rows, "x double, c string, policy_number string")
    assert drift.psi(ref, ref).first()["psi"] == 0.0
    assert drift.ks(ref, ref).first()["ks_statistic"] == 0.0
    same = {r["feature"]: r["drifted"] for r in drift.feature_drift(ref, ref).collect()}
    assert same == {"x": 0, "c": 0}
    moved = ref.withColumn("x", F.col("x") + 50).withColumn("c", F.when(F.col("c") == "a", "new").otherwise(F.col("c")))
    out = {r["feature"]: r for r in drift.feature_drift(ref, moved).collect()}
    assert out["x"]["drifted"] == 1 and out["c"]["chi2_statistic"] == math.inf and out["c"]["chi2_pvalue"] == 0.0
    total = drift.overall(drift.feature_drift(ref, moved)).first()
    assert total["drifted_features"] == 2 and total["overall_drift"] == pytest.approx(out["x"]["psi"] / 2)
    assert drift.overall(drift.feature_drift(ref, ref)).first()["severity"] == "none"


def test_psi_counts_null_rows_in_the_total(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    new = spark.createDataFrame([(float(i) if i < 50 else None,) for i in range(100)], "x double")
    want = sum(((n - r) * math.log(n / r)) for r, n in [(0.1, 0.1)] * 5 + [(0.1, 0.0001)] * 5)
    assert drift.psi(ref, new, ["x"]).first()["psi"] == pytest.approx(want, abs=1e-9)


def test_feature_table(spark):
    now = F.expr("TIMESTAMP_NTZ '2024-01-01 01:30:00'")
    writes = spark.sql("SELECT * FROM VALUES ('claims','a',TIMESTAMP_NTZ '2024-01-01 00:00:00',1.0D), ('claims','a',TIMESTAMP_NTZ '2024-01-01 01:00:00',2.0D), "
                       "('claims','b',TIMESTAMP_NTZ '2024-01-01 00:10:00',3.0D) AS t(feature_group, entity_id, stored_at, amount)")
    table = feature_table.upsert(None, writes)
    assert feature_table.get(table, "a", "claims", now).first()["amount"] == 2.0
    assert feature_table.get(table, "b", "claims", now).count() == 0
    ids = spark.createDataFrame([("a",), ("c",)], "entity_id string")
    assert {r["entity_id"]: r["amount"] for r in feature_table.get_batch(table, ids, "claims").collect()} == {"a": 2.0, "c": None}
    assert feature_table.delete(table, ids).select("entity_id").collect()[0][0] == "b"
    stats = feature_table.stats(table, now).first()
    assert (stats["stored_features"], stats["live"], stats["expired"]) == (2, 1, 1)


def test_batch_store_counts_blank_ids(spark):
    df = spark.createDataFrame([("a", 1), ("", 2), (None, 3)], "policy_number string, age int")
    rows, summary = feature_table.batch_store(df, F.current_timestamp())
    assert tuple(summary.first()) == (1, 2, 3) and rows.count() == 1


def test_run_log_edges(spark):
    now = F.expr("TIMESTAMP_NTZ '2024-01-02 00:00:00'")
    runs = spark.sql("SELECT * FROM VALUES (1,'p',TIMESTAMP_NTZ '2024-01-01 00:00:00','success',1.0D,5L), (2,'p',TIMESTAMP_NTZ '2024-01-01 23:00:00','failed',NULL,NULL), "
                     "(3,'q',TIMESTAMP_NTZ '2024-01-01 22:59:59','failed',2.0D,1L) AS t(run_id, pipeline_name, start_time, status, execution_time_seconds, rows_loaded)")
    assert {r["pipeline_name"]: r["due"] for r in runlog.due(runs, now).collect()} == {"p": 1, "q": 1}
    ages = runs.orderBy("run_id").select(runlog.age_text(F.col("start_time"), now)).collect()
    assert [a[0] for a in ages] == ["1d ago", "60m ago", "1h ago"]
    report = runlog.health_report(runs, now).first()
    assert report["total_runs"] == 2 and report["success_rate"] == 0.0 and report["health"] == "degraded"
    empty = runlog.health_report(runs.limit(0), now).first()
    assert empty["success_rate"] == 100.0 and empty["avg_execution_time"] == 0.0 and empty["health"] == "healthy"


def test_rates_on_empty_and_ties(spark):
    df = spark.createDataFrame([(0.5, "b"), (0.5, "a"), (0.9, "c"), (None, "d")], "r double, k string")
    assert {r["k"]: r["rank"] for r in rates.rank_rows(df, "r", ["k"], "rank").collect()} == {"c": 1, "a": 2, "b": 3, "d": 4}
    none = spark.createDataFrame([], "is_fraud int, total_claim_amount double")
    assert rates.kpis(none).first()["fraud_rate"] == 0.0 and rates.restore_check(none).first()["fraud_rate"] == 0.0
    assert rates.histogram(none, "total_claim_amount").count() == 0
    same = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [tuple(r) for r in rates.histogram(same, "x").collect()] == [(1, 2)]
    with pytest.raises(ValueError, match="limit"):
        rates.page(df, ["k"], 1001)


def test_augment_is_exact_and_keeps_the_originals(spark):
    df = spark.createDataFrame([(f"P{i}", 30 + i % 9, "OH") for i in range(300)], "policy_number string, age int, policy_state string")
    for target in (300, 301, 599, 600, 750, 1234):
        grown = sampling.augment(df, target)
        assert grown.count() == target
        per_key = grown.groupBy("policy_number").count().agg(F.min("count"), F.max("count"), F.count("*")).first()
        assert per_key[2] == 300 and per_key[1] - per_key[0] <= 1
    assert sampling.augment(df, 10).count() == 300


def test_augment_with_identical_rows(spark):
    df = spark.createDataFrame([("P", 30, "OH")] * 100, "policy_number string, age int, policy_state string")
    assert sampling.augment(df, 155).count() == 155


def test_small_ensemble_trains_stores_and_scores(spark, sf_dir, tmp_path):
    rows = claims(spark, sf_dir)
    small = {"booster_a": {"maxIter": 3, "maxDepth": 3, "seed": 42}, "forest": {"numTrees": 4, "maxDepth": 4, "seed": 42}}
    fit, held_out = model.train(rows, small)
    metrics = evaluate.model_metrics(held_out, len(fit.features)).first()
    assert metrics["accuracy"] >= 0.7 and metrics["auc_score"] >= 0.7
    path = os.path.join(str(tmp_path), "model")
    model.save(fit, path)
    again = model.load(spark, path)
    a = model.score(fit, rows).select("policy_number", F.round("probability", 9).alias("p"))
    b = model.score(again, rows).select("policy_number", F.round("probability", 9).alias("p"))
    assert a.exceptAll(b).count() == 0 and a.count() == rows.count()
    assert sum(v for _, v in model.importance(fit)) == pytest.approx(1.0)
    folds = model.cross_validate(rows, {"forest": {"numTrees": 3, "maxDepth": 3, "seed": 1}}, folds=3)
    assert folds.count() == 3 and folds.agg(F.min("auc")).first()[0] > 0.6
    with pytest.raises(FileNotFoundError):
        model.load(spark, os.path.join(str(tmp_path), "absent"))


def test_importance_and_auc_follow_the_labels(spark, sf_dir):
    """A planted column ranks first; labels that follow no column separate nothing; labels that follow one do."""
    rows = claims(spark, sf_dir)
    chance = F.pmod(F.xxhash64("policy_number", F.lit("label")), F.lit(4)) == 0
    chosen = {"forest": {"numTrees": 10, "maxDepth": 4, "seed": 42, "featureSubsetStrategy": "all"}}
    blind = rows.withColumn("is_fraud", chance.cast("int"))
    planted = blind.withColumn("planted", F.when(chance, 5.0).otherwise(1.0) + F.pmod(F.xxhash64("policy_number"), F.lit(3)))
    auc = {name: model.summarise_folds(model.cross_validate(df, chosen, folds=3)).first()["mean_auc"] for name, df in (("blind", blind), ("planted", planted))}
    assert 0.35 < auc["blind"] < 0.65 and auc["planted"] > 0.99
    fit, held_out = model.train(planted, chosen)
    top = model.top_importance(spark, fit, 3).orderBy("rank").collect()
    assert top[0]["feature"] == "planted" and top[0]["importance"] > 0.9 > 0.1 > top[1]["importance"]
    assert evaluate.model_metrics(held_out, len(fit.features)).first()["auc_score"] > 0.99
    fit, held_out = model.train(blind, chosen)
    gate = evaluate.gate(evaluate.model_metrics(held_out, len(fit.features))).first()
    assert gate["auc_score"] < 0.7 and not gate["passed"]


def upper_tail(x: float, df: int) -> float:
    """Of the chi-square distribution with an even number of degrees: a sum of Poisson weights, taken from their greatest."""
    mean, a = x / 2, df // 2
    mode = int(mean)
    below, above, term = 0.0, 0.0, 1.0
    for k in range(mode, max(mode - 60 * int(mean ** 0.5 + 10), -1), -1):
        below, above = (below + term, above) if k < a else (below, above + term)
        term *= k / mean
    term = 1.0
    for k in range(mode + 1, mode + 60 * int(mean ** 0.5 + 10)):
        term *= mean / k
        below, above = (below + term, above) if k < a else (below, above + term)
    return below / (below + above)


@pytest.mark.parametrize(("x", "df"), [(80.0, 2), (3.0, 4), (30.0, 10), (100.0, 60), (61.0, 60), (400_000.0, 400_000), (401_000.0, 400_000), (1_000_000.0, 1_000_000), (997_000.0, 1_000_000)])
def test_chi_square_tail(spark, x, df):
    got = spark.range(1).select(chi_square_pvalue(F.lit(x), F.lit(df))).first()[0]
    assert got == pytest.approx(upper_tail(x, df), rel=1e-9, abs=1e-12)
    if df == 2:
        assert got == pytest.approx(math.exp(-x / 2), rel=1e-12)


def test_keys_of_one_prefix_spread_over_the_ranges(spark):
    from claimscope.functions.order import running_totals

    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keys = spark.range(100_000).select(F.concat(F.lit("POL00000000"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("key"), F.lit(1).alias("one"))
        out = running_totals(keys, "key", ["one"])
        assert out.filter("one_upto <> cast(substr(key, 12) as int) + 1").count() == 0
        ranges = keys.repartitionByRange("key").groupBy(F.spark_partition_id()).count()
        assert ranges.count() >= 32 and ranges.agg(F.max("count")).first()[0] < 5 * 100_000 / 64
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_missed_bracket_is_looked_for_again(spark, monkeypatch):
    from claimscope.functions import order

    plain, calls = order._sketch, []

    def misled(values, parts, shares):
        out = plain(values, parts, shares)
        calls.append(len(shares))
        if len(calls) <= 2:  # the first brackets, and the first narrowing, lie beside the rank
            out = {k: (n, c, [e + 1000.0 if i < len(q) - 2 else e for i, e in enumerate(q)]) for k, (n, c, q) in out.items()}
        return out

    monkeypatch.setattr(order, "_sketch", misled)
    df = spark.range(20_001).select((F.col("id") * 7919 % 20_001).cast("double").alias("x"))
    assert order.exact_percentiles(df, {"x": F.col("x")}, [0.5], most_inside=500) == {"x": [10_000.0]}
    assert len(calls) > 2


def test_last_write_wins_without_a_sort(spark):
    rows = [("g", "a", i, j, f"{i}{j}") for i in range(3) for j in range(3)] + [("g", None, 1, None, "n"), (None, "a", None, 1, "x"), (None, "a", 0, 0, "y")]
    df = spark.createDataFrame(rows, "feature_group string, entity_id string, at int, seq int, v string")
    out = feature_table.latest(df, ["feature_group", "entity_id"], ["at", "seq"])
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted([("g", "a", 2, 2, "22"), ("g", None, 1, None, "n"), (None, "a", 0, 0, "y")], key=repr)


def test_ids_of_records_differ_where_the_records_do(spark):
    df = spark.createDataFrame([("a|b", None), ("a", "b"), (None, "a|b"), ("ab", ""), ("", "ab"), ("a", "b")], "x string, y string")
    ids = [r[0] for r in df.select(feature_table.entity_id(None, ["x", "y"])).collect()]
    assert len(set(ids)) == 5 and ids[1] == ids[5] and all(len(i) == 32 for i in ids)


def test_sums_of_small_and_large_amounts(spark):
    df = spark.createDataFrame([(0.00004,), (0.00004,), (1e15,)], "x double")
    assert df.limit(2).agg(rates.money("x", 6)).first()[0] == 0.00008 and df.agg(rates.money("x")).first()[0] == 1e15


def test_augment_does_not_depend_on_partitions(spark):
    rows = spark.range(60).select(F.concat(F.lit("p"), F.col("id")).alias("policy_number"), (F.col("id") % 9).cast("int").alias("age"),
                                  F.lit(None).cast("int").alias("months_as_customer"))
    rows = rows.unionByName(rows.limit(5))
    found = [sorted(map(tuple, sampling.augment(df, 151).collect()), key=repr) for df in (rows.coalesce(1), rows.repartition(7, "age"), rows.repartition(3).sortWithinPartitions(F.desc("age")))]
    assert found[0] == found[1] == found[2] and len(found[0]) == 151


def test_exact_ks_pvalue_counts_paths():
    from itertools import combinations

    for m, n in ((1, 1), (3, 4), (5, 5), (2, 7), (6, 4)):
        far = []
        for steps in combinations(range(m + n), m):
            i = j = most = 0
            for s in range(m + n):
                i, j = (i + 1, j) if s in steps else (i, j + 1)
                most = max(most, abs(i * n - j * m))
            far.append(most)
        for h in range(m * n + 1):
            assert abs(exact_ks_pvalue(h / (m * n), m, n) - sum(f >= h for f in far) / len(far)) < 1e-12


def far_paths(h: int, n: int) -> float:
    """Of two samples of ``n`` each: share of the orders that differ by ``h`` of n or more, by reflection, in whole numbers."""
    ways, k, out = math.comb(2 * n, n), 1, 0
    while n - k * h >= 0:
        out += (2 if k % 2 else -2) * math.comb(2 * n, n - k * h)
        k += 1
    return out / ways


@pytest.mark.parametrize(("h", "n"), [(1, 1), (20, 200), (5, 150), (150, 200), (192, 10_000), (500, 10_000)])
def test_exact_ks_pvalue_of_equal_sizes(h, n):
    assert exact_ks_pvalue(h / n, n, n) == pytest.approx(far_paths(h, n), rel=1e-9)


def test_exact_ks_pvalue_of_other_sizes():
    from fractions import Fraction

    m, n, bound = 60, 45, round(0.25 * 60 * 45)
    ways = {(0, 0): 1}
    for s in range(1, m + n + 1):
        ways = {(i, s - i): ways.get((i - 1, s - i), 0) + ways.get((i, s - i - 1), 0) for i in range(max(0, s - n), min(m, s) + 1)
                if abs(i * n - (s - i) * m) < bound}
    want = 1 - Fraction(ways[m, n], math.comb(m + n, m))
    assert exact_ks_pvalue(0.25, m, n) == pytest.approx(float(want), rel=1e-9)


def test_ks_is_exact_for_small_samples_only(spark):
    ref, new = spark.range(150).select(F.col("id").cast("double").alias("x")), spark.range(120).select((F.col("id") + 20).cast("double").alias("x"))
    exact, rough = (drift.ks(ref, new, exclude=(), exact_below=limit).first() for limit in (150, 149))
    assert exact["ks_statistic"] == rough["ks_statistic"] and exact["ks_pvalue"] == exact_ks_pvalue(exact["ks_statistic"], 150, 120)
    assert 0 < abs(exact["ks_pvalue"] - rough["ks_pvalue"]) < 0.05


def test_mart_average_is_not_rounded(spark):
    df = spark.createDataFrame([(0.00004,), (0.00004,), (None,)], "x double")
    assert df.agg(rates.exact_mean("x")).first()[0] == 0.00004


def test_samples_are_balanced_in_one_pass(spark, monkeypatch):
    """The weight of label 1 in each sample, from rows of the other parts; every sample's from the same counts."""
    rows = spark.createDataFrame([(0, 0)] * 6 + [(0, 1)] * 3 + [(1, 0)] * 4 + [(2, 1), (2, None), (None, 0)], "part int, label int")
    seen = {}
    monkeypatch.setattr(model.boosting, "binned", lambda rows: (spark.sparkContext.emptyRDD(), []))
    monkeypatch.setattr(model.boosting, "fit_boosters", lambda rows, wanted, table: seen.update(wanted) or {})
    spark.sparkContext.setJobGroup("balance", "")
    assert model.fit_many(rows, [0, 1, 2, model.NO_PART], {"booster_a": {}}) == {}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    factor = model.WEIGHT_FACTORS["booster_a"]
    assert [seen[k, "booster_a"][2] / factor for k in (0, 1, 2, model.NO_PART)] == pytest.approx([4.0, 1.5, 10 / 3, 2.5])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("balance")) <= 2


def test_passes_of_training_read_stored_splits(spark, monkeypatch):
    """Whether a row is held out, and its fold, are stored beside its vector: no later pass hashes keys again."""
    seen = []
    rows = [(f"P{i}", float(i % 7), "ab"[i % 2], i % 3 == 0) for i in range(60)]
    claims = spark.createDataFrame(rows, f"{model.KEY} string, total_claim_amount double, incident_severity string, y boolean")
    claims = claims.withColumn(model.LABEL, F.col("y").cast("int")).drop("y")

    def taken(rows, *_):
        seen.append(rows)
        raise StopIteration

    monkeypatch.setattr(model, "fit_many", taken)
    for fit in (model.train, model.cross_validate):
        with pytest.raises(StopIteration):
            fit(claims)
    train, folds = seen
    assert all("md5" not in r._jdf.queryExecution().toString() for r in seen)
    whole = evaluate.stratified_split(claims.withColumnRenamed(model.LABEL, "label"), "label", model.KEY, 0.2, 42).filter("is_test = 0")
    want = {r[0]: r["fold"] for r in evaluate.stratified_folds(whole, "label", model.KEY, 5, 43).collect()}
    assert {r[model.KEY]: r["fold"] for r in folds.collect()} == want and {r[model.KEY] for r in train.collect()} == set(want)


def test_wide_plans_keep_to_compiled_methods(spark, tmp_path):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), session.compiled(spark):
        assert spark.conf.get(name) == "8000"
        raise ValueError
    assert spark.conf.get(name) == before
    during = []
    tables.once(spark, str(tmp_path), "x", lambda path: during.append(spark.conf.get(name)))
    assert during == ["8000"]
