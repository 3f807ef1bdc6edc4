"""Steps that grow with the input: no shuffle of wide rows for a stored table, no file that one task writes, stream keys by group."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest

from claimscope.plans.catalog import QUERIES
from claimscope.sources.tables import claims, raw_claims
from claimscope.streaming import ingest

ROWS = 300


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders over ten years and their customers, staged."""
    root = str(tmp_path_factory.mktemp("tables"))
    orders = [(n, n * 7 % 37, "O", 1000.5 + 37 * n, datetime(1994, 1, 1) + timedelta(days=11 * n), "1-URGENT") for n in range(1, ROWS + 1)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                          "o_orderpriority string").coalesce(1).write.parquet(f"{root}/orders.parquet")
    customers = [(n, f"c{n}", n % 25, 10.0 * n - 50, "BUILDING") for n in range(40)]
    spark.createDataFrame(customers, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(
        f"{root}/customer.parquet")
    return root


def columns_of(plans, node):
    """Columns that each such node of the plans takes in."""
    return [int(n) for p in plans for n in re.findall(rf"\) {node}\s*\n(?:Output.*\n)?Input \[(\d+)\]", p)]


def test_stored_tables_shuffle_narrow_rows_only(spark, tables, plans_since):
    rows = claims(spark, tables)
    dealt = [int(n) for p in plans_since() for n in re.findall(r"\) Exchange\s*\nInput \[(\d+)\]: .*\nArguments: RoundRobin", p)]
    assert dealt and max(dealt) == 4, dealt  # the orders' columns that claims are made of
    assert rows.count() == ROWS and len(raw_claims(spark, tables).inputFiles()) >= spark.sparkContext.defaultParallelism


def test_fingerprint_of_another_order_in_portions(spark, tables, plans_since):
    claims(spark, tables)
    plans_since()
    assert [tuple(r) for r in QUERIES["change_fingerprint"](spark, tables).collect()] == [(ROWS, 1, 1)]
    assert not any("REPARTITION_BY_NUM" in p for p in plans_since())  # a fixed number of tasks for any number of rows


def test_change_files_are_written_by_many_tasks(spark, tables, plans_since):
    claims(spark, tables)
    plans_since()
    rows = QUERIES["change_files"](spark, tables).collect()
    assert max(columns_of(plans_since(), "Coalesce"), default=0) < 20
    assert sorted((r["part"], r["state"], r["different"]) for r in rows) == [(0, "same", 0), (1, "open", 0), (2, "open", 1), (3, "open", 1)]
    assert sum(r["row_count"] for r in rows) == ROWS


def test_incremental_files_are_written_by_many_tasks(spark, tables, plans_since):
    claims(spark, tables)
    plans_since()
    rows = QUERIES["incremental_files"](spark, tables).select("policy_number", "second_opened").collect()
    assert max(columns_of(plans_since(), "Coalesce"), default=0) < 20
    assert {r["second_opened"] for r in rows} == {1} and len({r["policy_number"] for r in rows}) >= ROWS - 5


def test_stream_keys_that_share_a_group(spark, tmp_path):
    schema = "policy_number string, n int"
    for batch, rows in enumerate([[("a", 1), ("b", 2), ("a", 3), (None, 4)], [("c", 5), ("a", 6), (None, 7), ("c", 8)], [("b", 9), ("d", 10), ("c", 11)]]):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in/part={batch}")
        stream = ingest.new_claims(ingest.file_stream(spark, f"{tmp_path}/in", schema), groups=1)
        (stream.writeStream.format("parquet").outputMode("append").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint")
         .trigger(availableNow=True).start().awaitTermination())
    back = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(r["n"] for r in back) == [1, 2, 3, 4, 5, 8, 10]
