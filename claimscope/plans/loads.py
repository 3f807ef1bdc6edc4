"""Source, sink, load and stream queries. Each writes to its own folder and reads back."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from claimscope import schema as S
from claimscope.functions.columns import col
from claimscope.operators import evaluate, relational, sampling
from claimscope.operators.clean import fit_medians
from claimscope.plans import jobs
from claimscope.plans.registry import CLAIMS_SQL, FILLED_SQL, define, query, quoted, rounded
from claimscope.session import cut_lineage, fresh_dir
from claimscope.sources import files
from claimscope.sources.tables import claims, relation
from claimscope.streaming import ingest

_CLEAN_LIST = ", ".join(quoted(c) for c in S.FINAL_COLUMNS)
_RAW_NAMES = [f.name for f in S.RAW_SCHEMA]
_RAW_LIST = ", ".join(quoted(c) for c in _RAW_NAMES)
_AT = "TIMESTAMP '2024-01-31 00:00:00'"


def raw(spark, sf_dir):
    return relation(spark, sf_dir, "claims_raw").select(*[col(c) for c in _RAW_NAMES])


def at():
    return F.expr("TIMESTAMP_NTZ '2024-01-31 00:00:00'")


# --- files and tables

@query("scan_csv_raw", f"SELECT {_RAW_LIST} FROM claims_raw", ["claims_raw"])
def scan_csv_raw(spark, sf_dir):
    path = fresh_dir(spark, "raw_csv")
    files.write_csv(raw(spark, sf_dir), path)
    return files.read_raw_csv(spark, path, escaped=True)


@query("scan_csv_clean", f"SELECT {_CLEAN_LIST} FROM claims", ["claims"])
def scan_csv_clean(spark, sf_dir):
    path = fresh_dir(spark, "clean_csv")
    files.write_csv(claims(spark, sf_dir), path)
    return files.read_clean_csv(spark, path)


@query("sink_csv", f"SELECT {', '.join(quoted(c) for c in S.FINAL_COLUMNS)}, (SELECT count(*) FROM claims) AS rows_written FROM claims", ["claims"])
def sink_csv(spark, sf_dir):
    path = fresh_dir(spark, "sink_csv")
    written = files.write_csv(claims(spark, sf_dir), path)
    return files.read_clean_csv(spark, path).withColumn("rows_written", F.lit(written).cast("bigint"))


@query("sink_table_replace", f"SELECT {', '.join(f'CAST({quoted(c)} AS DOUBLE) AS {quoted(c)}' if c in S.LOAD_NUMERIC else quoted(c) for c in S.FINAL_COLUMNS)}, "
       "(SELECT count(*) FROM claims) AS rows_written FROM claims", ["claims"])
def sink_table_replace(spark, sf_dir):
    """Replaced twice: the second load leaves one copy of the rows."""
    table, path = f"claims_{uuid.uuid4().hex}", fresh_dir(spark, "table")
    files.replace_table(claims(spark, sf_dir), table, path)
    written = files.replace_table(claims(spark, sf_dir), table, path)
    return spark.table(table).withColumn("rows_written", F.lit(written).cast("bigint"))


@query("sink_table_append", f"""SELECT {_CLEAN_LIST}, {_AT} AS processed_at FROM claims
  UNION ALL SELECT {_CLEAN_LIST}, {_AT} AS processed_at FROM claims WHERE is_fraud = 1""", ["claims"])
def sink_table_append(spark, sf_dir):
    path, df = fresh_dir(spark, "append"), claims(spark, sf_dir)
    files.append_table(df, path, at())
    files.append_table(df.filter("is_fraud = 1"), path, at())
    return spark.read.parquet(path)


def _snapshot(spark, sf_dir, root=None, name="s1", df=None):
    root = root or fresh_dir(spark, "snapshots")
    return files.write_snapshot(claims(spark, sf_dir) if df is None else df, root, name, "claims", at())


@query("snapshot_write", f"""SELECT 'claims' AS "table", count(*) AS row_count, {_AT} AS "timestamp", count(*) AS data_rows FROM claims""", ["claims"])
def snapshot_write(spark, sf_dir):
    path = _snapshot(spark, sf_dir)
    data = files.read_json(spark, os.path.join(path, "data"), S.CLEAN_SCHEMA)
    manifest = files.read_json(spark, os.path.join(path, "manifest"), files.MANIFEST)
    return manifest.withColumn("data_rows", data.select(F.count("*")).scalar())


@query("snapshot_restore", f"SELECT {_CLEAN_LIST} FROM claims", ["claims"])
def snapshot_restore(spark, sf_dir):
    """A table of some of the claims, replaced by what a snapshot of all of them holds."""
    df = claims(spark, sf_dir).withColumn("id", F.monotonically_increasing_id())
    path, table = _snapshot(spark, sf_dir, df=df), f"claims_{uuid.uuid4().hex}"
    files.replace_table(claims(spark, sf_dir).filter("is_fraud = 1"), table, fresh_dir(spark, "before"), numeric=[])
    files.restore_table(spark, path, S.CLEAN_SCHEMA, table, fresh_dir(spark, "restored"))
    return spark.table(table)


@query("snapshot_verify", f"""SELECT true AS valid, 'claims' AS "table", {_AT} AS "timestamp", count(*) AS row_count FROM claims
  UNION ALL SELECT false, NULL, NULL, NULL""", ["claims"])
def snapshot_verify(spark, sf_dir):
    """A good snapshot and one that is not there."""
    good = files.verify_snapshot(spark, _snapshot(spark, sf_dir))
    return good.unionByName(files.verify_snapshot(spark, fresh_dir(spark, "absent")))


@query("snapshot_list", f"""SELECT 's1' AS name, count(*) AS "rows", {_AT} AS created, 1 AS has_data FROM claims
  UNION ALL SELECT 's2', count(*) FILTER (is_fraud = 1), {_AT}, 1 FROM claims""", ["claims"])
def snapshot_list(spark, sf_dir):
    root, df = fresh_dir(spark, "snapshots"), claims(spark, sf_dir)
    _snapshot(spark, sf_dir, root, "s1", df)
    _snapshot(spark, sf_dir, root, "s2", df.filter("is_fraud = 1"))
    return files.list_snapshots(spark, root).select("name", "rows", "created", (F.col("size") > 0).cast("int").alias("has_data"))


@query("sink_json_metrics", "SELECT run_id, pipeline_name, start_time, status, execution_time_seconds, rows_extracted, rows_transformed, rows_loaded FROM run_log",
       ["run_log"])
def sink_json_metrics(spark, sf_dir):
    path, runs = fresh_dir(spark, "run_log"), relation(spark, sf_dir, "run_log")
    files.append_json(runs.filter("status = 'success'"), path)
    files.append_json(runs.filter("status <> 'success'"), path)
    return files.read_json(spark, path, runs.schema)


@query("sink_json_lineage", """SELECT 'node' AS kind, node_id AS from_node, NULL AS to_node, name AS detail, source AS run_id, 1::BIGINT AS n FROM lineage_nodes
  UNION ALL SELECT 'edge', from_node, to_node, transformation, 'r1', count(*) FROM lineage_edges GROUP BY from_node, to_node, transformation
  UNION ALL SELECT 'edge', from_node, to_node, transformation, 'r2', count(*) FROM lineage_edges WHERE from_node LIKE 'part:1%' GROUP BY from_node, to_node, transformation""",
       ["lineage_nodes", "lineage_edges"])
def sink_json_lineage(spark, sf_dir):
    """Nodes, and the edges that two runs reported, exported and read back."""
    path = fresh_dir(spark, "lineage")
    nodes = relational.upsert_nodes(relation(spark, sf_dir, "lineage_node_writes"))
    edges = relational.append_edges(None, relation(spark, sf_dir, "lineage_edges"), "r1")
    edges = relational.append_edges(edges, relation(spark, sf_dir, "lineage_edges").filter("from_node LIKE 'part:1%'"), "r2")
    files.append_json(nodes, os.path.join(path, "nodes"))
    files.append_json(edges, os.path.join(path, "edges"))
    found = files.read_json(spark, os.path.join(path, "nodes"), nodes.schema).select(
        F.lit("node").alias("kind"), F.col("node_id").alias("from_node"), F.lit(None).cast("string").alias("to_node"),
        F.col("name").alias("detail"), F.col("source").alias("run_id"))
    links = files.read_json(spark, os.path.join(path, "edges"), edges.schema).select(
        F.lit("edge").alias("kind"), "from_node", "to_node", F.col("transformation").alias("detail"), "run_id")
    return found.unionByName(links).groupBy("kind", "from_node", "to_node", "detail", "run_id").agg(F.count("*").alias("n"))


@query("sink_prediction_log", f"""SELECT policy_number, incident_date, probability, CASE WHEN probability >= 0.35 THEN 1 ELSE 0 END AS prediction,
  round_even(probability, 3) AS fraud_probability, CASE WHEN probability > 0.75 OR probability < 0.25 THEN 'high' ELSE 'medium' END AS confidence,
  CASE WHEN round_even(probability, 3) > 0.7 THEN 'HIGH' WHEN round_even(probability, 3) > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  {_AT} AS processed_at FROM scored""", ["scored"])
def sink_prediction_log(spark, sf_dir):
    path = fresh_dir(spark, "predictions")
    scored = relation(spark, sf_dir, "scored").drop("label")
    files.append_table(evaluate.decide(scored), path, at())
    return spark.read.parquet(path)


# --- loads

@query("etl_run", "SELECT 'success' AS status, count(*) AS rows_extracted, count(*) AS rows_transformed, count(*) AS rows_loaded, "
       "0::BIGINT AS rows_dropped, 100.0::DOUBLE AS data_quality_score, 3 AS warnings, count(*) AS table_rows FROM claims", ["claims"])
def etl_run(spark, sf_dir):
    root = fresh_dir(spark, "load")
    files.write_csv(raw(spark, sf_dir), f"{root}/raw")
    table = f"claims_{uuid.uuid4().hex}"
    jobs.run_load(spark, f"{root}/raw", f"{root}/clean", table, f"{root}/runs", "r1", table_path=f"{root}/table", escaped=True)
    run = jobs.read_runs(spark, f"{root}/runs")
    return run.select("status", "rows_extracted", "rows_transformed", "rows_loaded", "rows_dropped", "data_quality_score",
                      F.size("warnings").alias("warnings"), spark.table(table).select(F.count("*")).scalar().alias("table_rows"))


@query("run_metrics", "SELECT run_id, rows_extracted, rows_transformed, rows_loaded, rows_extracted - rows_transformed AS rows_dropped, "
       + rounded("rows_transformed * 100.0 / rows_extracted", 1) + """ AS data_quality_score, execution_time_seconds AS total_seconds,
  CASE WHEN status = 'failed' THEN 1 ELSE 0 END AS errors FROM run_log""", ["run_log"])
def run_metrics(spark, sf_dir):
    runs = relation(spark, sf_dir, "run_log")
    share = F.try_divide(F.col("rows_transformed") * F.lit(100.0), F.col("rows_extracted"))
    return runs.select(
        "run_id", "rows_extracted", "rows_transformed", "rows_loaded", (F.col("rows_extracted") - F.col("rows_transformed")).alias("rows_dropped"),
        F.round(share, 1).alias("data_quality_score"), F.col("execution_time_seconds").alias("total_seconds"),
        (F.col("status") == "failed").cast("int").alias("errors"))


@query("run_state_update", """SELECT 'success' AS kind, count(*) AS entries, (SELECT count(DISTINCT policy_number) FROM claims_raw) AS processed_keys
  FROM run_log WHERE status = 'success' UNION ALL SELECT 'failed', count(*), (SELECT count(DISTINCT policy_number) FROM claims_raw)
  FROM run_log WHERE status = 'failed'""", ["run_log", "claims_raw"])
def run_state_update(spark, sf_dir):
    """History of successes, of errors, and the merged processed keys after two loads."""
    path, runs, rows = fresh_dir(spark, "state"), relation(spark, sf_dir, "run_log"), raw(spark, sf_dir)
    files.append_json(runs.filter("status = 'success'"), path)
    files.append_json(runs.filter("status = 'failed'"), path)
    early = rows.filter(F.col("incident_date") < F.expr("TIMESTAMP_NTZ '1998-07-01 00:00:00'")).select("policy_number")
    keys = relational.union_keys(early, rows.select("policy_number"))
    history = files.read_json(spark, path, runs.schema)
    return history.groupBy(F.col("status").alias("kind")).agg(F.count("*").alias("entries")).withColumn(
        "processed_keys", keys.select(F.count("*")).scalar())


@query("change_fingerprint", "SELECT count(*) AS row_count, 1 AS same_in_any_order, 1 AS differs_by_one_value FROM claims_raw", ["claims_raw"])
def change_fingerprint(spark, sf_dir):
    """Row count, and whether the checksum is the same for the rows in another order and another after one change."""
    rows = raw(spark, sf_dir)
    print_now = jobs.fingerprint(rows)
    # a year at a time, in portions of the usual size however many rows a year has
    again = jobs.fingerprint(rows.hint("rebalance", F.col("auto_year"))).first()["checksum"]
    changed = jobs.fingerprint(rows.withColumn("age", F.when(F.col("policy_number") == "POL00000001", -1).otherwise(F.col("age")))).first()["checksum"]
    return print_now.select("row_count", (F.col("checksum") == again).cast("int").alias("same_in_any_order"),
                            (F.col("checksum") != changed).cast("int").alias("differs_by_one_value"))


@query("change_detect", """SELECT 'same' AS source, 1 AS skipped, count(*) AS row_count FROM claims_raw
  UNION ALL SELECT 'changed value', 0, count(*) FROM claims_raw UNION ALL SELECT 'fewer rows', 0, count(*) FROM claims_raw WHERE fraud_reported = 'Y'""",
       ["claims_raw"])
def change_detect(spark, sf_dir):
    df = raw(spark, sf_dir)
    before = jobs.fingerprint(df).first()
    control = {"last_checksum": before["checksum"], "last_row_count": before["row_count"]}
    cases = {
        "same": df, "fewer rows": df.filter("fraud_reported = 'Y'"),
        "changed value": df.withColumn("auto_year", F.when(F.col("policy_number") == "POL00000001", 1999).otherwise(F.col("auto_year"))),
    }
    lines = []
    for name, source in cases.items():
        now = jobs.fingerprint(source)
        row = now.first()
        skipped = jobs.unchanged(control, row["row_count"], row["checksum"])
        lines.append(now.select(F.lit(name).alias("source"), F.lit(int(skipped)).alias("skipped"), "row_count"))
    return lines[0].unionByName(lines[1]).unionByName(lines[2])


_EARLY = "incident_date < TIMESTAMP '1998-07-01 00:00:00'"
define("early_medians", "SELECT " + ", ".join(f"quantile_cont(CAST({quoted(c)} AS DOUBLE), 0.5) AS {quoted(c)}" for c in S.NUMERIC_COLUMNS)
       + f" FROM claims_raw WHERE {_EARLY}", ["claims_raw"])


def _loaded_sql() -> str:
    """Cleaned rows under the medians of the first load; later keys that were loaded before stay out."""
    filled = FILLED_SQL.replace("FROM medians m", "FROM early_medians m")
    return CLAIMS_SQL.replace("FROM filled", f"""FROM ({filled} WHERE {_EARLY.replace('incident_date', 'r.incident_date')}
      OR r.policy_number NOT IN (SELECT policy_number FROM claims_raw WHERE {_EARLY})) filled""")


define("loaded", _loaded_sql(), ["claims_raw", "early_medians"])


@query("incremental_load", f"SELECT {_CLEAN_LIST}, {_AT} AS processed_at FROM loaded", ["loaded"])
def incremental_load(spark, sf_dir):
    """First the early claims, then all of them, then all again: only new keys are added."""
    root, rows = fresh_dir(spark, "incremental"), raw(spark, sf_dir)
    early = rows.filter(F.col("incident_date") < F.expr("TIMESTAMP_NTZ '1998-07-01 00:00:00'"))
    medians = fit_medians(early, S.NUMERIC_COLUMNS)
    for source in (early, rows, rows):
        jobs.run_incremental(spark, source, f"{root}/table", f"{root}/control", f"{root}/keys", medians, at())
    return spark.read.parquet(f"{root}/table").drop("load")


def _arrivals(spark, sf_dir):
    rows = raw(spark, sf_dir)
    early = rows.filter(F.col("incident_date") < F.expr("TIMESTAMP_NTZ '1998-07-01 00:00:00'"))
    return rows, early, fit_medians(early, S.NUMERIC_COLUMNS)


def _read_raw(spark, paths):
    return spark.read.schema(S.RAW_SCHEMA).parquet(*paths)


@query("incremental_files", f"SELECT {_CLEAN_LIST}, {_AT} AS processed_at, 1 AS second_opened FROM loaded", ["loaded"])
def incremental_files(spark, sf_dir):
    """The same from a folder: files of the early claims, then files of all; the second load opens the later files only."""
    root = fresh_dir(spark, "folder")
    rows, early, medians = _arrivals(spark, sf_dir)
    opened, written = [], []
    for name, source in (("a", early), ("b", rows), ("c", None)):
        if source is not None:
            source.write.parquet(f"{root}/in/{name}")
        written.append(len(files.names(spark, f"{root}/in/{name}")))
        run = jobs.run_files(spark, f"{root}/in", _read_raw, f"{root}/table", f"{root}/control", f"{root}/keys", medians, at())
        opened.append(run["files_opened"])
    return spark.read.parquet(f"{root}/table").drop("load").withColumn("second_opened", F.lit(int(opened == written)))


@query("change_files", """SELECT h % 4 AS part, count(*) AS row_count, CASE WHEN h % 4 = 0 THEN 'same' ELSE 'open' END AS state,
  CASE WHEN h % 4 IN (2, 3) THEN 1 ELSE 0 END AS different FROM (SELECT auto_year AS h FROM claims_raw) GROUP BY h % 4""", ["claims_raw"])
def change_files(spark, sf_dir):
    """Files of claims in four folders by year: one stays, one is written again as it was, one with other values, and one is new."""
    root, rows = fresh_dir(spark, "files"), raw(spark, sf_dir).withColumn("part", F.col("auto_year") % 4)

    def write(part, df):
        df.filter(F.col("part") == part).write.mode("overwrite").parquet(f"{root}/in/part={part}")

    for part in (0, 1, 2):
        write(part, rows)
    before = cut_lineage(jobs.list_files(spark, f"{root}/in", "*.parquet").join(
        jobs.file_fingerprints(spark.read.parquet(f"{root}/in")), "path"), "states").withColumn("seen", F.lit(1))
    write(1, rows)
    write(2, rows.withColumn("age", F.col("age") + 1))
    write(3, rows)
    compared = jobs.compare_files(jobs.list_files(spark, f"{root}/in", "*.parquet"), before)
    # a file written again has another name here; what it holds is compared by its folder
    folder = F.regexp_extract("path", "part=([0-9]+)", 1).cast("int")
    state = compared.filter("state <> 'gone'").groupBy(folder.alias("part")).agg(F.max("state").alias("state"))
    now = jobs.combine_fingerprints(jobs.file_fingerprints(spark.read.parquet(f"{root}/in")), folder)
    was = jobs.combine_fingerprints(before, folder).select("part", F.col("checksum").alias("_then"))
    return state.join(now, "part").join(was, "part", "left").select(
        "part", "row_count", "state", (~F.col("checksum").eqNullSafe(F.col("_then"))).cast("int").alias("different"))


@query("run_record", """SELECT pipeline_name, CAST(sum(CASE WHEN status = 'success' THEN rows_loaded ELSE 0 END) AS BIGINT) AS rows_loaded, count(*) AS runs FROM run_log
  GROUP BY pipeline_name""", ["run_log"])
def run_record(spark, sf_dir):
    """A record for each pipeline, written from its first runs, then again from all of them: one is left."""
    path, runs = fresh_dir(spark, "records"), relation(spark, sf_dir, "run_log")

    def records(of):
        return of.groupBy("pipeline_name").agg(F.sum(F.when(F.col("status") == "success", F.col("rows_loaded")).otherwise(0)).alias("rows_loaded"), F.count("*").alias("runs"))

    files.replace_json(records(runs.filter("run_id % 2 = 0")), path, ["pipeline_name"])
    files.replace_json(records(runs), path, ["pipeline_name"])
    return files.read_json(spark, path, "pipeline_name string, rows_loaded bigint, runs bigint")


# --- streams

@query("stream_load", f"SELECT {_CLEAN_LIST}, {_AT} AS processed_at FROM loaded", ["loaded"])
def stream_load(spark, sf_dir):
    """Files that overlap, as a stream: the early claims, then all, then nothing. It loads what ``incremental_load`` does."""
    root = fresh_dir(spark, "stream_load")
    rows, early, medians = _arrivals(spark, sf_dir)
    for name, source in (("a", early), ("b", rows), ("c", None)):
        if source is not None:
            source.write.parquet(f"{root}/in/part={name}")
        ingest.load_stream(spark, f"{root}/in", S.RAW_SCHEMA, medians, f"{root}/table", f"{root}/checkpoint", at=at()).awaitTermination()
    return spark.read.parquet(f"{root}/table").drop("load")


_CONTRACT_OK = """(policy_state = '' OR policy_state IN ('OH', 'IN', 'IL', 'PA', 'NY') OR policy_state IS NULL)
  AND (incident_severity = '' OR incident_severity IN ('Trivial Damage', 'Minor Damage', 'Major Damage', 'Total Loss') OR incident_severity IS NULL)
  AND coalesce(months_as_customer, 0) >= 0 AND coalesce(age, 0) >= 0 AND coalesce(policy_annual_premium, 0) >= 0 AND coalesce(total_claim_amount, 0) >= 0"""


def _accepted_sql() -> str:
    return CLAIMS_SQL.replace("FROM filled", f"FROM ({FILLED_SQL} WHERE {_CONTRACT_OK.replace('age,', 'r.age,')}) filled")


define("accepted", _accepted_sql(), ["claims_raw", "medians"])


@query("stream_ingest", f"SELECT {_CLEAN_LIST}, (SELECT count(*) FROM claims_raw) - (SELECT count(*) FROM accepted) AS quarantined FROM accepted", ["accepted"])
def stream_ingest(spark, sf_dir):
    """Two files, then a run that finds nothing new."""
    root, rows = fresh_dir(spark, "stream"), raw(spark, sf_dir)
    medians = fit_medians(rows, S.NUMERIC_COLUMNS)
    early = F.col("incident_date") < F.expr("TIMESTAMP_NTZ '1998-07-01 00:00:00'")
    rows.filter(early).write.parquet(f"{root}/in/part=a")
    rows.filter(~early).write.parquet(f"{root}/in/part=b")
    for _ in range(2):
        ingest.ingest(spark, f"{root}/in", S.RAW_SCHEMA, medians, f"{root}/accepted", f"{root}/quarantine", f"{root}/checkpoint").awaitTermination()
    bad = spark.read.parquet(f"{root}/quarantine")
    return spark.read.parquet(f"{root}/accepted").drop("batch").withColumn("quarantined", bad.select(F.count("*")).scalar())


@query("health_stream", f"""SELECT s AS window_start, s + INTERVAL 24 HOUR AS window_end, count(*) AS runs,
  count(*) FILTER (status = 'success')::DOUBLE / count(*) AS success_rate,
  coalesce({rounded('avg(execution_time_seconds)', 10)}, 0) AS avg_execution_time
  FROM (SELECT *, unnest(range(date_trunc('hour', start_time) - INTERVAL 23 HOUR, date_trunc('hour', start_time) + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS s FROM run_log)
  GROUP BY s""", ["run_log"])
def health_stream(spark, sf_dir):
    root = fresh_dir(spark, "health")
    events = relation(spark, sf_dir, "run_log").select("run_id", "pipeline_name", F.col("start_time").cast("timestamp").alias("start_time"), "status",
                                                       "execution_time_seconds")
    events.write.parquet(f"{root}/in")
    stream = ingest.health_hours(ingest.file_stream(spark, f"{root}/in", ingest.RUN_EVENT))
    ingest.run_to_files(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    out = ingest.health_windows(spark.read.parquet(f"{root}/out"))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"), "runs",
                      "success_rate", "avg_execution_time")


# --- sampling

@query("augment_rows", """SELECT policy_number, count(*) AS originals, 1 AS within, 1 AS kept, (SELECT count(*) * 5 // 2 FROM claims_raw) AS total
  FROM claims_raw GROUP BY policy_number""", ["claims_raw"])
def augment_rows(spark, sf_dir):
    """Two and a half times the claims: per key its rows, whether each came two or three times, whether one kept its own age, and all rows."""
    df = raw(spark, sf_dir)
    grown = cut_lineage(sampling.augment(df, df.count() * 5 // 2), "grown")
    total = grown.count()
    before = df.groupBy("policy_number").agg(F.count("*").alias("originals"), F.collect_set(F.coalesce(F.col("age").cast("double"), F.lit(-1.0))).alias("ages"))
    after = grown.groupBy(F.col("policy_number").alias("_k")).agg(F.count("*").alias("n"), F.collect_set(F.coalesce("age", F.lit(-1.0))).alias("grown_ages"))
    n, k = F.col("n"), F.col("originals")
    return before.join(after, F.col("policy_number") == F.col("_k")).select(
        "policy_number", "originals", n.between(2 * k, 3 * k).cast("int").alias("within"),
        (F.size(F.array_except("ages", "grown_ages")) == 0).cast("int").alias("kept"), F.lit(total).cast("bigint").alias("total"))
