from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from claimscope import schema as S
from claimscope.operators.clean import fit_medians
from claimscope.operators.contract import split_records, validate_records
from claimscope.operators.clean import transform_claims
from claimscope.operators.quality import CriticalIssue
from claimscope.plans import jobs
from claimscope.sources import files
from claimscope.sources.tables import raw_claims
from claimscope.streaming import ingest

def at():
    return F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")


def test_csv_null_tokens_and_order(spark, tmp_path):
    path = os.path.join(str(tmp_path), "c.csv")
    with open(path, "w") as f:
        f.write('age,policy_number,extra,months_as_customer,policy_state\n35,"P,1",x,NA, in\nabc,P2,,12,None\n,P3,"a ""q""",n/a,\n')
    rows = {r["policy_number"]: r for r in files.read_raw_csv(spark, path).collect()}
    assert rows["P,1"]["age"] == 35 and rows["P,1"]["months_as_customer"] is None and rows["P,1"]["policy_state"] == " in"
    assert rows["P2"]["age"] is None and rows["P2"]["policy_state"] is None and rows["P3"]["extra"] == 'a "q"'


def test_load_records_failure(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("P1", 30)], "policy_number string, age int").write.option("header", True).csv(f"{root}/raw")
    with pytest.raises(CriticalIssue):
        jobs.run_load(spark, f"{root}/raw", f"{root}/clean", "t_fail", f"{root}/runs", "r1", table_path=f"{root}/table")
    run = jobs.read_runs(spark, f"{root}/runs").first()
    assert run["status"] == "failed" and "missing_columns" in run["errors"][0] and not os.path.exists(f"{root}/table")


def test_full_then_load_only(spark, sf_dir, tmp_path):
    root, raw = str(tmp_path), raw_claims(spark, sf_dir)
    files.write_csv(raw, f"{root}/raw")
    full = jobs.run_load(spark, f"{root}/raw", f"{root}/clean", "t_full", f"{root}/runs", "r1", table_path=f"{root}/table")
    again = jobs.run_load(spark, f"{root}/raw", f"{root}/clean", "t_full", f"{root}/runs", "r2", mode="load_only", table_path=f"{root}/table")
    n = raw.count()
    assert full["rows_loaded"] == again["rows_loaded"] == n == spark.table("t_full").count()
    assert full["warnings"] and jobs.read_runs(spark, f"{root}/runs").count() == 2


def test_incremental_is_idempotent(spark, sf_dir, tmp_path):
    root, raw = str(tmp_path), raw_claims(spark, sf_dir)
    first = raw.filter("policy_number < 'POL00000700'")
    medians = fit_medians(raw, S.NUMERIC_COLUMNS)

    def run(df):
        return jobs.run_incremental(spark, df, f"{root}/table", f"{root}/control", f"{root}/keys", medians, at())

    assert run(first)["rows_loaded"] == first.count()
    assert run(first)["status"] == "skipped"
    # a run that broke off after its writes: without its control row it is repeated, not doubled
    assert run(raw)["rows_loaded"] == raw.count() - first.count()
    rows = spark.read.schema(jobs.CONTROL_SCHEMA).json(f"{root}/control").collect()
    spark.createDataFrame([r for r in rows if r["last_row_count"] == first.count()], jobs.CONTROL_SCHEMA).write.json(f"{root}/control2")
    jobs.run_incremental(spark, raw, f"{root}/table", f"{root}/control2", f"{root}/keys", medians, at())
    assert spark.read.parquet(f"{root}/table").count() == raw.count()


def test_fingerprint_ignores_order(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    assert jobs.fingerprint(df).first() == jobs.fingerprint(df.orderBy(F.desc("id")).repartition(3)).first()
    assert jobs.fingerprint(df).first() != jobs.fingerprint(df.withColumn("x", F.col("x") + (F.col("id") == 5).cast("int"))).first()


def test_snapshot_round_trip(spark, sf_dir, tmp_path):
    root, raw = str(tmp_path), raw_claims(spark, sf_dir)
    path = files.write_snapshot(raw.withColumn("id", F.lit(1)), root, "one", "claims_raw", at())
    assert files.verify_snapshot(spark, path).first()["valid"]
    assert files.restore_snapshot(spark, path, raw.schema, f"{root}-restored") == raw.count()
    assert raw.exceptAll(spark.read.parquet(f"{root}-restored")).count() == 0
    listed = files.list_snapshots(spark, root).first()
    assert listed["name"] == "one" and listed["rows"] == raw.count() and listed["size"] > 0
    assert not files.verify_snapshot(spark, f"{root}/none").first()["valid"]


def test_stream_equals_batch_and_reads_each_file_once(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    raw = raw_claims(spark, sf_dir).select(*[f"`{f.name}`" for f in S.RAW_SCHEMA])
    medians = fit_medians(raw, S.NUMERIC_COLUMNS)

    def run():
        ingest.ingest(spark, f"{root}/in", S.RAW_SCHEMA, medians, f"{root}/ok", f"{root}/bad", f"{root}/cp", per_trigger=1).awaitTermination()

    raw.repartition(3).write.parquet(f"{root}/in")
    run()
    run()
    good, bad = split_records(validate_records(raw))
    want = transform_claims(good.drop("valid", "error"), medians=medians)
    got = spark.read.parquet(f"{root}/ok").drop("batch")
    assert got.count() == want.count() and want.exceptAll(got).count() == 0
    assert spark.read.parquet(f"{root}/bad").count() == bad.count()


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    texts = ['a\nb', 'quote " and, comma', "back\\slash \\n kept", "end\r\n", "\\", " lead", 'mix "\n",\\r']
    df = spark.createDataFrame([(t, float(i)) for i, t in enumerate(texts)], "policy_number string, total_claim_amount double")
    assert files.write_csv(df.repartition(2), str(tmp_path / "own")) == len(texts)
    back = files.read_raw_csv(spark, str(tmp_path / "own"), escaped=True)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[1]) == [(t, float(i)) for i, t in enumerate(texts)]
    (tmp_path / "other.csv").write_text('policy_number,age\n"P\n1",30\nP2,40\n')
    rows = files.read_raw_csv(spark, str(tmp_path / "other.csv"), multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("P\n1", 30), ("P2", 40)]


def test_null_keys_are_loaded_once(spark, sf_dir, tmp_path):
    root, raw = str(tmp_path), raw_claims(spark, sf_dir).limit(40)
    raw = raw.withColumn("policy_number", F.when(F.col("age") % 2 == 0, F.col("policy_number"))).cache()
    medians = fit_medians(raw, S.NUMERIC_COLUMNS)
    for source in (raw, raw.withColumn("auto_year", F.lit(1999)), raw.withColumn("auto_year", F.lit(2000))):
        jobs.run_incremental(spark, source, f"{root}/table", f"{root}/control", f"{root}/keys", medians, at())
    assert raw.filter("policy_number IS NULL").count() > 0
    assert spark.read.parquet(f"{root}/table").count() == raw.count()


def test_restore_swaps_the_table(spark, sf_dir, tmp_path):
    root, raw = str(tmp_path), raw_claims(spark, sf_dir)
    path = files.write_snapshot(raw, root, "one", "t_swap", at())
    files.replace_table(raw.limit(3), "t_swap", f"{root}/before", numeric=[])
    assert files.restore_table(spark, path, raw.schema, "t_swap", f"{root}/after") == raw.count() == spark.table("t_swap").count()
    with pytest.raises(Exception):
        files.restore_table(spark, f"{root}/none", raw.schema, "t_swap", f"{root}/third")
    assert spark.table("t_swap").count() == raw.count()


def test_failure_text_is_kept_whole(spark, tmp_path, monkeypatch):
    text = "x" * 5000

    def fail(*args, **kwargs):
        raise ValueError(text)

    monkeypatch.setattr(files, "read_raw_csv", fail)
    with pytest.raises(ValueError):
        jobs.run_load(spark, "none", f"{tmp_path}/clean", "t_none", f"{tmp_path}/runs", "r1")
    assert jobs.read_runs(spark, f"{tmp_path}/runs").first()["errors"] == [text]


def test_late_events_change_the_windows_they_are_in(spark, tmp_path):
    root, form = str(tmp_path), "run_id bigint, pipeline_name string, start_time timestamp, status string, execution_time_seconds double"
    for n, rows in enumerate(([(1, "a", "2024-01-01 00:10:00", "success", 0.00004), (2, "a", "2024-01-01 01:00:00", "failed", 1e15)],
                              [(3, "a", "2024-01-01 00:20:00", "success", 0.00004)])):
        df = spark.createDataFrame(rows, "run_id bigint, pipeline_name string, t string, status string, execution_time_seconds double")
        df.select("run_id", "pipeline_name", F.to_timestamp("t").alias("start_time"), "status", "execution_time_seconds").write.parquet(f"{root}/in/n={n}")
        hours = ingest.health_hours(ingest.file_stream(spark, f"{root}/in", form))
        ingest.run_to_files(hours, f"{root}/out", f"{root}/cp").awaitTermination()
    rows = {r["window_end"].isoformat(): r for r in ingest.health_windows(spark.read.parquet(f"{root}/out")).collect()}
    first, last = rows[min(rows)], rows[max(rows)]
    assert first["runs"] == 2 and first["avg_execution_time"] == pytest.approx(0.00004) and last["runs"] == 1 and last["success_rate"] == 0
    assert len(rows) == 25
