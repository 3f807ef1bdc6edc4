"""Key filters, loads file by file, keyed streams, paging by place, lineage over hops, run records."""

from __future__ import annotations

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from claimscope import schema as S
from claimscope.operators import key_filter, relational
from claimscope.plans import jobs
from claimscope.session import fresh_dir
from claimscope.sources import files
from claimscope.sources.paging import PagedTable
from claimscope.streaming import ingest


# --- key filters

def test_filter_finds_every_key_and_few_others(spark):
    keys = spark.range(5000).select(F.concat(F.lit("K"), F.col("id")).alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    known = key_filter.build(keys, "k", blocks=256)
    assert known.count() <= 256
    assert key_filter.ask(keys, "k", known, 256).filter("NOT _may").count() == 0
    others = spark.range(5000, 25000).select(F.concat(F.lit("K"), F.col("id")).alias("k"))
    assert key_filter.ask(others, "k", known, 256).filter("_may").count() < 200


def test_filters_merge(spark):
    a, b = (spark.range(n, n + 100).select(F.col("id").alias("k")) for n in (0, 100))
    merged = key_filter.merge(key_filter.build(a, "k", 8).unionByName(key_filter.build(b, "k", 8)))
    whole = key_filter.build(a.unionByName(b), "k", 8)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    with pytest.raises(ValueError):
        key_filter.build(a, "k", key_filter.MOST_BLOCKS + 1)


@pytest.mark.parametrize("blocks", [1, 64])  # the first is full: every row is checked, and the result is the same
def test_skip_processed_with_a_filter_is_the_anti_join(spark, blocks):
    df = spark.createDataFrame([(f"p{i % 700}" if i % 50 else None, i) for i in range(2000)], "key string, x int")
    done = spark.createDataFrame([(f"p{i}",) for i in range(0, 300)] * 2 + [(None,)], "key string")
    known = key_filter.build(done, "key", blocks)
    plain = sorted(relational.skip_processed(df, done, "key").collect(), key=repr)
    assert sorted(relational.skip_processed(df, done, "key", known, blocks).collect(), key=repr) == plain
    empty = done.limit(0)
    assert relational.skip_processed(df, empty, "key", key_filter.build(empty, "key", blocks), blocks).count() == 2000


def test_new_rows_skip_the_shuffle(spark):
    df = spark.range(20000).select(F.concat(F.lit("n"), F.col("id")).alias("key"))
    done = spark.range(1000).select(F.concat(F.lit("o"), F.col("id")).alias("key"))
    found = relational.skip_processed(df, done, "key", key_filter.build(done, "key", 1024), 1024)
    assert found.count() == 20000
    may = key_filter.ask(df, "key", key_filter.build(done, "key", 1024), 1024).filter("_may").count()
    assert may < 20  # the rows that meet the keys


# --- loads file by file

def claims_of(spark, numbers, amount=100.0):
    rows = spark.createDataFrame([(f"POL{n:05d}",) for n in numbers], "policy_number string")
    full = rows.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name != "policy_number" else F.col("policy_number") for f in S.RAW_SCHEMA])
    return full.withColumn("total_claim_amount", F.lit(amount)).withColumn("fraud_reported", F.lit("N"))


def read(spark, paths):
    read.paths = paths
    return spark.read.schema(S.RAW_SCHEMA).parquet(*paths)


def run(spark, root):
    read.paths = []
    return jobs.run_files(spark, f"{root}/in", read, f"{root}/table", f"{root}/control", f"{root}/keys", {c: 0.0 for c in S.NUMERIC_COLUMNS},
                          F.expr("TIMESTAMP '2024-01-31 00:00:00'"))


def keys_of(spark, root):
    return sorted(r["policy_number"] for r in spark.read.parquet(f"{root}/table").select("policy_number").collect())


def test_unchanged_files_are_not_read_again(spark, tmp_path):
    root = str(tmp_path)
    claims_of(spark, range(10)).coalesce(1).write.parquet(f"{root}/in/a")
    claims_of(spark, range(10, 20)).coalesce(1).write.parquet(f"{root}/in/b")
    assert run(spark, root) == {"status": "success", "files_same": 0, "files_opened": 2, "files_loaded": 2, "files_gone": 0, "rows_loaded": 20}
    again = run(spark, root)
    assert again["status"] == "skipped" and again["files_same"] == 2 and read.paths == []

    # what an unchanged file holds is made unreadable without changing length or time: nobody looks
    old = next(p for p in (tmp_path / "in" / "a").iterdir() if p.name.endswith(".parquet"))
    stat, content = old.stat(), old.read_bytes()
    old.write_bytes(b"x" * len(content))
    os.utime(old, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    (tmp_path / "in" / "a" / f".{old.name}.crc").unlink()
    claims_of(spark, range(15, 25)).coalesce(1).write.parquet(f"{root}/in/c")
    third = run(spark, root)
    assert third["files_opened"] == 1 and third["rows_loaded"] == 5 and "/in/c/" in read.paths[0]
    old.write_bytes(content)
    os.utime(old, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert keys_of(spark, root) == [f"Pol{n:05d}" for n in range(25)]


def test_touched_changed_and_removed_files(spark, tmp_path):
    root = str(tmp_path)
    for name, numbers in (("a", range(5)), ("b", range(5, 10)), ("c", range(10, 15))):
        claims_of(spark, numbers).coalesce(1).write.parquet(f"{root}/in/{name}")
    run(spark, root)
    found = {name: next(p for p in (tmp_path / "in" / name).iterdir() if p.name.endswith(".parquet")) for name in "abc"}
    later = time.time() + 100
    os.utime(found["a"], (later, later))
    found["c"].unlink()
    claims_of(spark, range(5, 12), 7.0).coalesce(1).write.mode("overwrite").parquet(f"{root}/in/b")
    got = run(spark, root)
    assert (got["files_opened"], got["files_loaded"], got["files_gone"], got["rows_loaded"]) == (2, 1, 2, 0)  # the old file of b is gone too
    assert run(spark, root)["status"] == "skipped" and read.paths == []
    states = jobs.read_file_states(spark, f"{root}/control")
    whole = jobs.fingerprint(spark.read.schema(S.RAW_SCHEMA).option("recursiveFileLookup", True).parquet(f"{root}/in")).first()
    assert tuple(jobs.combine_fingerprints(states).first()) == tuple(whole)


def test_a_load_that_broke_off_is_repeated_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    claims_of(spark, range(5)).coalesce(1).write.parquet(f"{root}/in/a")
    real = key_filter.build
    monkeypatch.setattr(jobs.key_filter, "build", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, root)  # rows and keys are written, the state of the file is not
    monkeypatch.setattr(jobs.key_filter, "build", real)
    assert run(spark, root)["rows_loaded"] == 5 and keys_of(spark, root) == [f"Pol{n:05d}" for n in range(5)]


# --- a stream by key

def test_stream_over_overlapping_files(spark, tmp_path):
    root, medians = str(tmp_path), {c: 0.0 for c in S.NUMERIC_COLUMNS}
    arrivals = [claims_of(spark, [1, 2, 2, 3]), claims_of(spark, [3, 4, 1, 4], 5.0), claims_of(spark, [1, 4], 6.0)]
    for n, rows in enumerate(arrivals):
        rows.write.parquet(f"{root}/in/part={n}")
        ingest.load_stream(spark, f"{root}/in", S.RAW_SCHEMA, medians, f"{root}/table", f"{root}/checkpoint").awaitTermination()
        jobs.run_incremental(spark, rows, f"{root}/batch", f"{root}/control", f"{root}/keys", medians)
    columns = [c for c in S.FINAL_COLUMNS]
    stream, batch = (sorted(map(tuple, spark.read.parquet(f"{root}/{name}").select(*[F.col(f"`{c}`") for c in columns]).collect()), key=repr) for name in ("table", "batch"))
    assert stream == batch and len(stream) == 6


def test_values_pass_the_stream_as_they_are(spark, tmp_path):
    schema = "policy_number string, i int, d double, t timestamp_ntz, s string"
    rows = [(None, None, float("nan"), None, None), ("a", 2**31 - 1, 0.1, None, 'q"\\\n'), ("b", -1, 1e300, __import__("datetime").datetime(2001, 2, 3, 4, 5, 6, 789123), "é"), (None, 7, None, None, "")]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in")
    stream = ingest.new_claims(ingest.file_stream(spark, f"{tmp_path}/in", schema))
    (stream.writeStream.format("parquet").outputMode("append").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    back = spark.read.parquet(f"{tmp_path}/out").select("policy_number", "i", "d", "t", "s").collect()
    assert sorted(map(repr, map(tuple, back))) == sorted(map(repr, rows))


# --- pages

def test_pages_cover_a_table_once(spark):
    dice = random.Random(4)
    rows = [(dice.choice([None, "a", "b", "c", "dd"]), dice.choice([None, 1.0, 2.5]), dice.randrange(3)) for _ in range(500)]
    kept = PagedTable.write(spark.createDataFrame(rows, "k string, x double, n int"), fresh_dir(spark, "pages"), ["k", "x"], ranges=7)
    order = sorted(rows, key=lambda r: [(v is not None, v) if v is not None else (False, 0) for v in r])
    got = []
    for at in range(0, 520, 60):
        page = kept.at(at, 60).collect()
        assert [r["_place"] for r in page] == list(range(at, min(at + 60, 500)))
        got += [tuple(r)[:3] for r in page]
    assert got == order
    for values in (("b",), ("b", 2.5), ("zz",), ("a", None), (None,)):
        before = sum([(v is not None, v) if v is not None else (False, 0) for v in r[:len(values)]]
                     < [(v is not None, v) if v is not None else (False, 0) for v in values] for r in order)
        assert kept.find(*values) == before
    with pytest.raises(ValueError):
        kept.at(0, 0)
    with pytest.raises(ValueError):
        kept.find("a", 1.0, 2)


def test_a_deep_page_reads_its_ranges_only(spark):
    kept = PagedTable.write(spark.range(20000), fresh_dir(spark, "pages"), ["id"], ranges=20)
    page = kept.at(17_000, 100)
    assert [r["id"] for r in page.collect()] == list(range(17_000, 17_100))
    scan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and len(kept.ranges()) == 21
    read = [r for r, start in kept.ranges()[:-1] if start <= 17_099][-2:]
    spread = kept.rows.filter(F.col("_range").isin(read))
    assert spread.count() < 2500 and len(spread.inputFiles()) >= 1
    assert PagedTable.write(spark.range(0), fresh_dir(spark, "pages"), ["id"]).at(0, 5).count() == 0


# --- lineage

def test_lineage_over_hops_and_cycles(spark):
    edges = spark.createDataFrame([("a", "b", "t"), ("b", "c", "t"), ("c", "a", "t"), ("c", "d", "t"), ("d", "e", "t"), ("a", "c", "u"), ("x", "x", "t"), ("a", "b", "t"), (None, "a", "t")],
                                  "from_node string, to_node string, transformation string")
    at = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    nodes = spark.createDataFrame([(n, n.upper(), "s") for n in "abcex"] * 2, "node_id string, name string, source string").withColumn("written_at", at)

    def hops(df):
        return {r["node_id"]: r["hops"] for r in df.collect()}

    assert hops(relational.all_downstream(nodes, edges, "a")) == {"b": 1, "c": 1, "e": 3}  # d has no entry and is passed through
    assert hops(relational.all_downstream(nodes, edges, "a", hops=1)) == {"b": 1, "c": 1}
    assert hops(relational.all_upstream(nodes, edges, "e")) == {"c": 2, "a": 3, "b": 3}
    assert hops(relational.all_upstream(nodes, edges, "x")) == {} and hops(relational.all_upstream(nodes, edges, "nobody")) == {}


# --- run records and table swaps

def test_a_run_that_is_repeated_replaces_its_record(spark, tmp_path):
    record = {k: None for k in ("run_id", "start_time", "status", "rows_extracted", "rows_transformed", "rows_loaded", "rows_dropped", "extraction_seconds",
                                "transformation_seconds", "load_seconds", "total_seconds", "data_quality_score", "errors", "warnings")}
    for run_id, status in (("r/1", "failed"), ("r2", "success"), ("r/1", "success"), ("007", "success")):
        jobs.record_run(spark, f"{tmp_path}/log", record | {"run_id": run_id, "status": status, "errors": ["x"]})
    runs = jobs.read_runs(spark, f"{tmp_path}/log")
    assert runs.columns[0] == "run_id" and sorted((r["run_id"], r["status"]) for r in runs.collect()) == [("007", "success"), ("r/1", "success"), ("r2", "success")]


def test_a_failed_load_leaves_the_table(spark, tmp_path):
    table = f"kept_{time.time_ns()}"
    assert files.replace_table(spark.range(5), table, str(tmp_path), numeric=[]) == 5
    bad = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        files.replace_table(bad, table, str(tmp_path), numeric=[])
    assert spark.table(table).count() == 5
    for n in (7, 8, 9):
        assert files.replace_table(spark.table(table).limit(2).unionByName(spark.range(n - 2)), table, str(tmp_path), numeric=[]) == n
    assert spark.table(table).count() == 9 and len(files.names(spark, str(tmp_path))) <= 3


def test_steps_of_a_job_go_with_it(spark, tmp_path):
    import glob

    from claimscope.session import cut_lineage, fresh_dir, scratch, shared_root

    before = set(glob.glob(f"{shared_root(spark)}/claimscope/*"))
    path = str(tmp_path / "result")
    with scratch(spark, "job"):
        step = cut_lineage(spark.range(100), "step")
        with scratch(spark, "inner"):
            cut_lineage(step, "below")
        kept = fresh_dir(spark, "kept", keep=True)
        step.filter("id >= 40").write.parquet(path)
    with pytest.raises(ValueError), scratch(spark, "broken"):
        cut_lineage(spark.range(1), "step")
        raise ValueError
    assert spark.read.parquet(path).count() == 60 and "/job-" not in kept
    assert set(glob.glob(f"{shared_root(spark)}/claimscope/*")) == before
