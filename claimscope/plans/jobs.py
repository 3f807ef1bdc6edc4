"""Batch jobs: the full load, the incremental load, and their run records."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscope import schema as S
from claimscope.functions.columns import col
from claimscope.operators import key_filter, quality
from claimscope.operators.clean import fit_medians, transform_claims
from claimscope.operators.relational import skip_processed
from claimscope.session import cut_lineage, scratch
from claimscope.sources import files

RUN_SCHEMA = (
    "run_id string, start_time timestamp, status string, rows_extracted bigint, rows_transformed bigint, rows_loaded bigint, "
    "rows_dropped bigint, extraction_seconds double, transformation_seconds double, load_seconds double, total_seconds double, "
    "data_quality_score double, errors array<string>, warnings array<string>"
)
CONTROL_SCHEMA = "last_run timestamp, last_row_count bigint, last_checksum string"


def _tidy(job: Callable[..., dict]) -> Callable[..., dict]:
    """The job, whose stored steps go when it ends; what it leaves lies in the paths it is given."""
    @wraps(job)
    def run(spark: SparkSession, *args, **kwargs) -> dict:
        with scratch(spark, job.__name__):
            return job(spark, *args, **kwargs)
    return run


def record_run(spark: SparkSession, log_path: str, record: Mapping) -> None:
    """Put one run into the run log; a run that is recorded again, as after a repetition, replaces what it left before."""
    files.replace_json(spark.createDataFrame([dict(record)], RUN_SCHEMA), log_path, ["run_id"])


def read_runs(spark: SparkSession, log_path: str) -> DataFrame:
    return files.read_json(spark, log_path, RUN_SCHEMA)


def quality_score(rows_in: int, rows_out: int) -> float:
    return round(rows_out * 100 / rows_in, 1) if rows_in > 0 else 0.0


@_tidy
def run_load(
    spark: SparkSession, raw_path: str, clean_path: str, table: str, log_path: str, run_id: str,
    mode: str = "full", validate: bool = True, table_path: str | None = None, escaped: bool = False, multi_line: bool = False,
) -> dict:
    """Extract, clean, validate, write clean text, load the table, record the run.

    ``mode="load_only"`` loads the clean text that is already there. A failure is recorded and
    raised again. Row counts come out of the writes themselves. ``escaped`` and ``multi_line`` say how the raw text
    writes line ends inside a field, as in ``files.read_csv``.
    """
    start = time.monotonic()
    record = {
        "run_id": run_id, "start_time": datetime.now(timezone.utc), "status": "failed", "rows_extracted": 0,
        "rows_transformed": 0, "rows_loaded": 0, "rows_dropped": 0, "extraction_seconds": 0.0, "transformation_seconds": 0.0,
        "load_seconds": 0.0, "total_seconds": 0.0, "data_quality_score": 0.0, "errors": [], "warnings": [],
    }
    try:
        if mode == "full":
            mark = time.monotonic()
            raw = files.read_raw_csv(spark, raw_path, escaped, multi_line)
            medians = fit_medians(raw.select(*[col(c) for c in S.NUMERIC_COLUMNS if c in raw.columns]))
            record["extraction_seconds"] = round(time.monotonic() - mark, 2)
            mark = time.monotonic()
            counted, seen = files.count_rows(raw)
            clean = transform_claims(counted, medians=medians)
            if validate:
                quality.require_columns(clean, S.REQUIRED_COLUMNS)
            written = files.write_csv(clean, clean_path)
            record["rows_extracted"], record["rows_transformed"] = seen.get["rows"], written
            record["transformation_seconds"] = round(time.monotonic() - mark, 2)
        mark = time.monotonic()
        clean = files.read_clean_csv(spark, clean_path)
        if mode == "full" and validate:
            report = quality.quality_report(clean, S.REQUIRED_COLUMNS, S.CLEAN_RANGES, S.CLEAN_VALUES, "policy_number")
            record["warnings"] = [f"{issue}: {message}" for issue, message in quality.quality_gate(report)]
        record["rows_loaded"] = files.replace_table(clean, table, table_path)
        if mode != "full":
            record["rows_extracted"] = record["rows_transformed"] = record["rows_loaded"]
        record["load_seconds"] = round(time.monotonic() - mark, 2)
        record["rows_dropped"] = record["rows_extracted"] - record["rows_transformed"]
        record["data_quality_score"] = quality_score(record["rows_extracted"], record["rows_transformed"])
        record["status"] = "success"
    except Exception as e:
        record["errors"] = [str(e)]
        raise
    finally:
        record["total_seconds"] = round(time.monotonic() - start, 2)
        record_run(spark, log_path, record)
    return record


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and order-free checksum of a table: one aggregate, no sort, no shuffle of rows."""
    row = F.xxhash64(*[col(c) for c in df.columns]).cast("decimal(38,0)")
    return df.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(row), F.lit(0)).cast("string").alias("checksum"),
    )


def read_control(spark: SparkSession, path: str) -> dict:
    """The newest control row; blank before the first run."""
    row = None
    if files.exists(spark, path):
        row = files.read_json(spark, path, CONTROL_SCHEMA).orderBy(F.desc("last_run")).first()
    return row.asDict() if row else {"last_run": None, "last_row_count": 0, "last_checksum": None}


def unchanged(control: Mapping, row_count: int, checksum: str) -> bool:
    """Skip only if checksum and row count are both as before."""
    return control["last_checksum"] == checksum and control["last_row_count"] == row_count


def _load_new(raw: DataFrame, table_path: str, keys_path: str, load: str, medians: Mapping[str, float | None], at: Column, key: str) -> int:
    """Clean and append the rows whose key no other load has, then keep the load's keys and their filter.

    Keys lie in ``keys_path/keys/load=…`` and filters in ``keys_path/filters/load=…``. A filter has a fixed number of rows, and the
    filters of all loads together tell which rows need no look at the keys. A load writes its filter before its keys, so there are
    no keys that the filters lack, whenever a load breaks off.
    """
    spark, new = raw.sparkSession, raw
    keys, filters = os.path.join(keys_path, "keys"), os.path.join(keys_path, "filters")
    if any(name != f"load={load}" for name in files.names(spark, keys)):
        done = spark.read.schema(f"{key} string, load string").parquet(keys).filter(F.col("load") != load)
        words = ", ".join(f"w{i} bigint" for i in range(key_filter.WORDS))
        known = key_filter.merge(spark.read.schema(f"block int, {words}, load string").parquet(filters).filter(F.col("load") != load))
        new = skip_processed(raw, done, key, known)
        new = cut_lineage(new, "new-rows")  # looked for once, then loaded and listed
    loaded = files.append_table(transform_claims(new, medians=medians), table_path, at, load)
    key_filter.build(new, key).coalesce(1).write.mode("overwrite").parquet(os.path.join(filters, f"load={load}"))
    new.select(col(key)).distinct().write.mode("overwrite").parquet(os.path.join(keys, f"load={load}"))
    return loaded


@_tidy
def run_incremental(
    spark: SparkSession, raw: DataFrame, table_path: str, control_path: str, keys_path: str,
    medians: Mapping[str, float | None], at: Column | None = None, key: str = "policy_number",
) -> dict:
    """Clean and append the rows whose key was not loaded before; remember the source state.

    ``medians`` are the stored statistics of the first load: filling new rows must not depend on
    which rows happen to arrive together. Loaded keys are kept raw, since cleaning changes the
    case of a key. Rows and keys go to partitions named after the source state, so a run that
    broke off can simply be repeated.
    """
    at = F.current_timestamp() if at is None else at
    print_now = fingerprint(raw).first()
    control = read_control(spark, control_path)
    if unchanged(control, print_now["row_count"], print_now["checksum"]):
        return {"status": "skipped", "rows_extracted": 0, "rows_loaded": 0}
    load = print_now["checksum"].replace("-", "m")
    loaded = _load_new(raw, table_path, keys_path, load, medians, at, key)
    state = spark.range(1).select(
        F.current_timestamp().alias("last_run"), F.lit(print_now["row_count"]).alias("last_row_count"),
        F.lit(print_now["checksum"]).alias("last_checksum"))
    files.append_json(state, control_path)
    return {"status": "success", "rows_extracted": print_now["row_count"], "rows_loaded": loaded}


# --- loads of a folder, file by file

FILE_STATE = "path string, length bigint, modified timestamp, row_count bigint, checksum string, seen bigint"


def _plain_path(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``path``, ``length``, ``modified`` of every file, from the listing: no content is read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return found.select(_plain_path(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified"))


def file_fingerprints(df: DataFrame) -> DataFrame:
    """``path``, ``row_count`` and checksum of each file that ``df`` reads: the leaves of a tree. They combine before the shuffle."""
    row = F.xxhash64(*[col(c) for c in df.columns]).cast("decimal(38,0)")
    return df.groupBy(_plain_path(F.col("_metadata.file_path")).alias("path")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(row).cast("string").alias("checksum"))


def combine_fingerprints(leaves: DataFrame, by: Column | None = None) -> DataFrame:
    """Count and checksum of several files together, for each value of ``by`` (as a folder) or all: what ``fingerprint`` gives for
    their rows."""
    grouped = leaves.groupBy(by.alias("part")) if by is not None else leaves.groupBy()
    return grouped.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
                       F.coalesce(F.sum(F.col("checksum").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum"))


def read_file_states(spark: SparkSession, path: str) -> DataFrame:
    """The last state of each file that a load has seen and that was there then."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], FILE_STATE)
    rows = spark.read.schema(FILE_STATE).parquet(path)
    last = rows.groupBy("path").agg(F.max("seen").alias("seen"))
    return rows.join(last, ["path", "seen"]).filter("length IS NOT NULL").select(*[f.split()[0] for f in FILE_STATE.split(", ")])


def compare_files(listing: DataFrame, known: DataFrame) -> DataFrame:
    """Every file with ``state``: ``same`` where length and time are as before, ``open`` where its content must be looked at, ``gone``."""
    then = known.select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"), "row_count", "checksum")
    state = (F.when(F.col("length").isNull(), "gone").when((F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified")), "same")
             .otherwise("open"))
    return listing.join(then, "path", "full_outer").withColumn("state", state).drop("_length", "_modified")


@_tidy
def run_files(
    spark: SparkSession, folder: str, read: Callable[[SparkSession, list[str]], DataFrame], table_path: str, control_path: str, keys_path: str,
    medians: Mapping[str, float | None], at: Column | None = None, key: str = "policy_number", pattern: str = "*.parquet",
) -> dict:
    """Load what is new in a folder, reading only files that were not there, or not like that, at the last load.

    Files with the length and time of before are not opened. Of the others, those whose rows give the checksum of before were only
    touched; the rest is loaded like any new rows (``run_incremental``): keys loaded before stay out. ``control_path`` keeps a state for
    each file; a load that broke off leaves no state and is repeated whole, into the partition that it owns. The load is named by
    the states of its files. Paths of opened files pass the driver, as those of every scan do.
    """
    at = F.current_timestamp() if at is None else at
    known = read_file_states(spark, control_path)
    compared = cut_lineage(compare_files(list_files(spark, folder, pattern), known), "file-states")
    counts = {r["state"]: r["count"] for r in compared.groupBy("state").count().collect()}
    opened = [r["path"] for r in compared.filter("state = 'open'").select("path").collect()]
    out = {"status": "skipped", "files_same": counts.get("same", 0), "files_opened": len(opened), "files_loaded": 0, "files_gone": counts.get("gone", 0),
           "rows_loaded": 0}
    leaves = None
    if opened:
        rows = read(spark, opened)
        leaves = cut_lineage(file_fingerprints(rows), "file-leaves")
        now = leaves.select("path", F.col("row_count").alias("_rows"), F.col("checksum").alias("_sum"))
        was = compared.filter("state = 'open'").join(now, "path", "left")
        different = was.filter(~(F.col("row_count").eqNullSafe(F.col("_rows")) & F.col("checksum").eqNullSafe(F.col("_sum"))))
        load_paths = sorted(r["path"] for r in different.select("path").collect())
        if load_paths:
            load = combine_fingerprints(leaves.filter(F.col("path").isin(load_paths))).first()["checksum"].replace("-", "m")
            fresh = rows if len(load_paths) == len(opened) else read(spark, load_paths)
            out["rows_loaded"] = _load_new(fresh, table_path, keys_path, load, medians, at, key)
            out |= {"status": "success", "files_loaded": len(load_paths)}
    if opened or out["files_gone"]:
        moved = compared.filter("state <> 'same'").drop("row_count", "checksum")
        if leaves is None:
            leaves = spark.createDataFrame([], "path string, row_count bigint, checksum string")
        seen = (known.agg(F.max("seen")).first()[0] or 0) + 1
        state = moved.join(leaves, "path", "left").select("path", "length", "modified", "row_count", "checksum", F.lit(seen).cast("bigint").alias("seen"))
        state.coalesce(1).write.mode("append").parquet(control_path)
    return out
