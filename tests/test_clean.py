from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from claimscope import schema as S
from claimscope.functions.columns import bin_column, normalise_nulls, strip, title_case, to_number
from claimscope.functions.order import exact_percentiles, running_totals
from claimscope.operators import clean


def column(df, name):
    return [r[0] for r in df.select(f"`{name}`").collect()]


def test_title_case_is_python_title(spark):
    texts = ["Multi-vehicle col", "3rd party", "PhD", "o'neil", " BMW\t", "", "ÉCOLE été", "a1b2", "x-y z", " ny\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(title_case(strip(F.col("t"))).alias("t"))
    assert column(df, "t") == [t.strip().title() for t in texts]


@pytest.mark.parametrize(("value", "label"), [
    (-1, None), (0, None), (1, "0-1yr"), (12, "0-1yr"), (13, "1-2yr"), (24, "1-2yr"), (48, "2-4yr"), (120, "4-10yr"),
    (120.5, "10yr+"), (500, "10yr+"), (501, None), (None, None)])
def test_bins_are_right_closed(spark, value, label):
    df = spark.createDataFrame([(None if value is None else float(value),)], "v double")
    assert df.select(bin_column(F.col("v"), S.TENURE_EDGES, S.TENURE_LABELS)).first()[0] == label


def test_numbers_and_null_tokens(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), (None,), ("NA",)], "t string")
    assert [r[0] for r in df.select(to_number(F.col("t"))).collect()] == [1.5, None, None, None, None]
    assert [r[0] for r in df.select(normalise_nulls(F.col("t"), S.NULL_TOKENS)).collect()] == ["1.5", "x", None, None, None]


def test_transform_chain(sample):
    out = clean.transform_claims(sample)
    assert out.columns == [c for c in S.FINAL_COLUMNS if c in out.columns] and "_c39" not in out.columns
    rows = {r["policy_number"]: r for r in out.collect()}
    assert set(rows) == {"Pol1", "Pol2", "Pol3", "Pol4"}
    assert rows["Pol2"]["months_as_customer"] == 12.0 and rows["Pol3"]["age"] == 35.0
    assert rows["Pol3"]["policy_annual_premium"] == 800.0
    assert rows["Pol3"]["policy_state"] == "Unknown" and rows["Pol4"]["policy_state"] == "3Rd O'Neil-Phd"
    assert rows["Pol3"]["tenure_group"] is None and rows["Pol4"]["age_group"] == "65+"
    assert [rows[f"Pol{i}"]["is_fraud"] for i in (1, 2, 3, 4)] == [0, 1, 0, 0]
    assert rows["Pol3"]["has_claim"] == 0 and rows["Pol4"]["has_claim"] == 1


def test_median_is_not_truncated(spark):
    df = spark.createDataFrame([(45,), (46,), (None,)], "age int")
    assert sorted(column(clean.fill_median(df), "age")) == [45.0, 45.5, 46.0]


def test_all_null_and_empty(spark):
    df = spark.createDataFrame([(None, "a")], "age int, policy_state string")
    assert clean.transform_claims(df).first()["age"] is None
    assert clean.transform_claims(df.limit(0)).count() == 0


def test_transform_keeps_rows_and_limits_columns(spark, dirty):
    assert clean.transform_claims(dirty).count() == 3
    assert clean.transform_claims(dirty, columns=["age_group"]).columns == ["age_group"]


@pytest.mark.parametrize("most_inside", [5_000_000, 10])
def test_percentiles_against_sorting(spark, most_inside):
    rng = random.Random(7)
    rows = [(rng.random() if i % 3 else 0.25, float(rng.randrange(5)), float(i) if i % 50 == 0 else None) for i in range(30_000)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = exact_percentiles(df, {c: F.col(c) for c in "abc"}, probs, most_inside=most_inside)
    for i, c in enumerate("abc"):
        values = sorted(r[i] for r in rows if r[i] is not None)
        for p, q in zip(probs, got[c], strict=True):
            at = (len(values) - 1) * p
            lo, hi = values[math.floor(at)], values[math.ceil(at)]
            assert q == pytest.approx(lo + (hi - lo) * (at - math.floor(at)), abs=1e-12)


def test_percentiles_small_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,), (None,)], "a double")
    assert exact_percentiles(df, {"a": F.col("a")}, [0.5]) == {"a": [1.5]}
    assert exact_percentiles(df.limit(0), {"a": F.col("a")}, [0.5]) == {"a": [None]}
    assert statistics.median([1.0, 2.0]) == 1.5


def test_running_totals(spark):
    rows = [(g, float(v), (v * 7) % 11) for g in ("x", "y") for v in range(500)]
    df = spark.createDataFrame(rows, "g string, v double, n int").repartition(4)
    got = {(r["g"], r["v"]): r["n_upto"] for r in running_totals(df, "v", ["n"], ["g"]).collect()}
    for g in ("x", "y"):
        total = 0
        for _, v, n in sorted(r for r in rows if r[0] == g):
            total += n
            assert got[g, v] == total
