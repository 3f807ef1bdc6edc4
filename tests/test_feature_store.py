"""The kept feature table: what sessions see of each other, plans, removals, payloads."""

from __future__ import annotations

import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from claimscope.session import fresh_dir
from claimscope.sources import files
from claimscope.sources.feature_store import FeatureStore, from_payload, store_key, to_payload

DAY = dt.datetime(2024, 1, 1)


def at(hours):
    return DAY + dt.timedelta(hours=hours)


def writes(spark, rows):
    return spark.createDataFrame(rows, "feature_group string, entity_id string, stored_at timestamp_ntz, seq bigint, x double")


def values(df):
    return sorted((r["entity_id"], r["x"]) for r in from_payload(df, "x double").collect())


@pytest.fixture
def store(spark):
    return FeatureStore(spark, fresh_dir(spark, "store"), buckets=4)


def test_sessions_see_each_other(spark, store):
    store.upsert(writes(spark, [("g", "a", at(0), 1, 1.0), ("g", "b", at(0), 1, 2.0), (None, "c", at(0), 1, 9.0), ("g", None, at(0), 1, 9.0)]), "one")
    other = FeatureStore(spark.newSession(), store.root, buckets=99)
    assert other.buckets == 4 and values(other.current()) == [("a", 1.0), ("b", 2.0)]
    assert store.fold() == 1 and store.fold() == 1
    other.upsert(writes(spark, [("g", "a", at(1), 1, 3.0), ("g", "b", at(-1), 1, 8.0), ("h", "a", at(5), 1, 4.0)]), "two")
    for _ in range(2):
        assert values(store.current()) == [("a", 3.0), ("a", 4.0), ("b", 2.0)]
        assert values(store.get("a", "g", F.lit(at(1)).cast("timestamp_ntz"))) == [("a", 3.0)]
        assert store.get("a", "g", F.lit(at(3)).cast("timestamp_ntz")).count() == 0
        ids = spark.createDataFrame([("a",), ("a",), ("zz",), (None,)], "entity_id string")
        assert values(store.lookup(ids, "g")) == [("a", 3.0), ("zz", None)]
        other.fold()
    assert store.version() == 2 and files.names(spark, store.root + "/delta") == []


def test_a_batch_that_is_repeated_counts_once(spark, store):
    rows = [("g", "a", at(0), 1, 1.0), ("g", "a", at(0), 2, 2.0), ("g", "a", at(0), 2, 2.0)]
    for _ in range(2):
        assert store.upsert(writes(spark, rows), "one") == 3
    store.fold()
    store.upsert(writes(spark, rows), "one")  # again after it was folded
    assert values(store.current()) == [("a", 2.0)]
    store.fold()
    assert values(store.current()) == [("a", 2.0)]


def test_only_one_of_two_folds_counts(spark, store):
    store.upsert(writes(spark, [("g", "a", at(0), 1, 1.0)]), "one")
    files.create_once(spark, store.root + "/heads/1", store.root + "/base/elsewhere")
    with pytest.raises(Py4JJavaError):
        files.create_once(spark, store.root + "/heads/1", "late")


def test_removals(spark, store):
    store.upsert(writes(spark, [("g", "a", at(0), 1, 1.0), ("g", "b", at(2), 1, 2.0), ("h", "a", at(0), 1, 5.0)]), "one")
    store.fold()
    store.delete(spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "entity_id string"), "two", F.lit(at(1)).cast("timestamp_ntz"), "g")
    assert values(store.current()) == [("a", 5.0), ("b", 2.0)]
    store.fold()
    store.upsert(writes(spark, [("g", "a", at(0.5), 1, 7.0)]), "late")  # older than its removal, which is still known
    assert values(store.current()) == [("a", 5.0), ("b", 2.0)]
    store.upsert(writes(spark, [("g", "a", at(1.5), 1, 8.0)]), "back")
    assert values(store.current()) == [("a", 5.0), ("a", 8.0), ("b", 2.0)]
    store.fold(F.lit(at(9)).cast("timestamp_ntz"))
    assert store.base().filter("removed").count() == 0


def test_the_table_does_not_move(spark, store):
    spark_rows = spark.range(2000).select(F.lit("g").alias("feature_group"), F.col("id").cast("string").alias("entity_id"),
                                          F.lit(at(0)).cast("timestamp_ntz").alias("stored_at"), F.col("id").alias("seq"), F.col("id").cast("double").alias("x"))
    store.upsert(spark_rows, "all")
    store.fold()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = store.lookup(spark.range(0, 4000, 7).select(F.col("id").cast("string").alias("entity_id")), "g")
        plan = found._jdf.queryExecution().executedPlan().toString()
        joins = [i for i, line in enumerate(plan.splitlines()) if "MergeJoin" in line]
        table = next(line for line in plan.splitlines() if "features_" in line)
        assert joins and "Bucketed: true" in table
        below = plan[plan.index(plan.splitlines()[joins[0]]):]
        assert below.count("Exchange") == 1 and "Exchange" not in below[below.index("[key", below.index("Exchange") + 60):]  # the ids move, the table does not
        assert found.filter("seq IS NOT NULL").count() == 286
        one = store.base().filter(F.col("key") == store_key(F.lit("g"), F.lit("7")))
        assert "EqualTo(key,1:g:7)" in one._jdf.queryExecution().executedPlan().toString() and one.rdd.getNumPartitions() <= 2  # one bucket
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_nothing_stored(spark, store):
    ids = spark.createDataFrame([("a",)], "entity_id string")
    assert store.current().count() == 0 and store.fold() == 0 and values(store.lookup(ids, "g")) == [("a", None)]
    assert store.upsert(writes(spark, []), "none") == 0 and store.current().count() == 0


def test_payloads_of_other_schemas(spark):
    texts = ['{"a":1,"b":"x"}', '{"a":2}', '{"b":null,"c":[1]}', '{"a":"no"}', "{\"a\":1", "[1]", "7", "", None, " {} ", "null"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, features string")
    got = {r["n"]: (r["a"], r["b"], r["rejected"]) for r in from_payload(df, "a bigint, b string").collect()}
    assert [got[n] for n in (0, 1, 2, 8, 9)] == [(1, "x", None), (2, None, None), (None, None, None), (None, None, None), (None, None, None)]
    assert all(got[n][2] == texts[n] for n in (3, 4, 5, 6, 7, 10))


def test_payload_round_trip_and_rejects(spark, store):
    rows = writes(spark, [("g", "a", at(0), 1, 0.1), ("g", "b", at(0), 1, None), ("g", "c", at(0), 1, float(2**60))])
    assert '"x":null' in to_payload(rows).filter("entity_id = 'b'").first()["features"]
    texts = spark.createDataFrame([("g", "a", at(1), '{"x":2.5,"y":1}'), ("g", "b", at(1), '{"x":'), ("g", None, at(1), "{}"), ("g", "d", at(1), None)],
                                  "feature_group string, entity_id string, stored_at timestamp_ntz, features string")
    store.upsert(rows, "rows")
    assert store.upsert_payloads(texts, "texts", "x double") == (1, 3)
    assert values(store.current()) == [("a", 2.5), ("b", None), ("c", float(2**60))]
    assert sorted(r["reason"] for r in store.rejects().collect()) == ["bad payload", "no key", "no payload"]
