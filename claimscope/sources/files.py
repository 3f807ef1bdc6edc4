"""Files: delimited text in and out, snapshots, appended logs."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.functions.columns import col, normalise_nulls
from claimscope.operators.clean import coerce_numeric
from claimscope.schema import CLEAN_SCHEMA, LOAD_NUMERIC, NULL_TOKENS, RAW_SCHEMA


# Micro-seconds both ways; the default text form of a timestamp keeps milli-seconds only.
_EXACT_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


# Line ends inside a field are written as these, so that every record stays one line and files can be split.
_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))
_BACKSLASH = "\ue000"


def _on_one_line(c: Column) -> Column:
    for plain, written in _ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def _as_it_was(c: Column) -> Column:
    """Undoes ``_on_one_line``: doubled backslashes step aside while the others are read."""
    c = F.replace(c, F.lit("\\\\"), F.lit(_BACKSLASH))
    for plain, written in _ESCAPES[1:]:
        c = F.replace(c, F.lit(written), F.lit(plain))
    return F.replace(c, F.lit(_BACKSLASH), F.lit("\\"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, tokens: Sequence[str] = NULL_TOKENS,
             escaped: bool = False, multi_line: bool = False) -> DataFrame:
    """Headered text as typed columns, matched to ``schema`` by name; columns it lacks stay text.

    Blank and ``NA``-like text is null, and so is text that does not parse as its type: fields
    are read as text, then tried as the declared type. Types are not inferred, which would cost
    a second pass over the files.

    ``escaped`` reads files of ``write_csv``, in which a field's line ends are written as backslash letters. Files of
    others that have line ends inside quotes need ``multi_line``; Spark then reads a file in one task, so it is not the
    default.
    """
    rows = (
        spark.read.option("header", True).option("escape", '"').option("nullValue", "").option("multiLine", multi_line)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    types = {f.name: f.dataType for f in schema}

    def field(name: str) -> Column:
        text, kind = normalise_nulls(col(name), tokens), types.get(name, T.StringType())
        return _as_it_was(text) if escaped and isinstance(kind, T.StringType) else text.try_cast(kind)

    return rows.select(*[field(c).alias(c) for c in rows.columns])


def read_raw_csv(spark: SparkSession, path: str, escaped: bool = False, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, RAW_SCHEMA, escaped=escaped, multi_line=multi_line)


def read_clean_csv(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned text, as ``write_csv`` left it; groups outside the bins come back as null."""
    return read_csv(spark, path, CLEAN_SCHEMA, escaped=True)


def write_csv(df: DataFrame, path: str) -> int:
    """Write with a header and without an index; the row count comes from the same pass. Every record is one line."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    counted, done = count_rows(df.withColumns({c: _on_one_line(col(c)) for c in texts}) if texts else df)
    (counted.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).options(**_EXACT_TIME).csv(path))
    return done.get["rows"]


def count_rows(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def replace_table(df: DataFrame, table: str, path: str | None = None, numeric: Sequence[str] = LOAD_NUMERIC) -> int:
    """Coerce the listed columns to numbers, replace the table, return the rows written.

    With a ``path``, each load gets a folder of its own below it, and the table moves there in one step when the write is complete:
    readers find the old rows until then, a load that fails leaves them, and the rows may come from the table itself. The folder of
    the load before stays for those who still read it; older ones go.
    """
    spark = df.sparkSession
    counted, done = count_rows(coerce_numeric(df, numeric))
    if path is None:
        counted.write.mode("overwrite").format("parquet").saveAsTable(table)
        return done.get["rows"]
    before = names(spark, path)
    out = os.path.join(path, f"load-{(int(before[-1].split('-')[1]) if before else 0) + 1:09d}")
    counted.write.mode("overwrite").parquet(out)
    place_table(spark, table, out)
    for old in before[:-1]:
        remove(spark, os.path.join(path, old))
    return done.get["rows"]


def place_table(spark: SparkSession, table: str, path: str) -> None:
    """Make the rows in ``path`` those of ``table``, in one step."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet")


def append_table(df: DataFrame, path: str, at: Column | None = None, load: str | None = None) -> int:
    """Stamp ``processed_at``, append, return the rows written.

    A named ``load`` owns a partition of the table: repeating it after a failure replaces what
    it wrote before instead of adding the rows twice.
    """
    counted, done = count_rows(df.withColumn("processed_at", F.current_timestamp() if at is None else at))
    if load is None:
        counted.write.mode("append").parquet(path)
    else:
        counted.write.mode("overwrite").parquet(os.path.join(path, f"load={load}"))
    return done.get["rows"]


def append_json(df: DataFrame, path: str) -> int:
    counted, done = count_rows(df)
    counted.write.mode("append").options(**_EXACT_TIME).json(path)
    return done.get["rows"]


def replace_json(df: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Write rows to the partitions of their ``keys``, replacing what those partitions held: writing a run again leaves one copy of it,
    and other runs stay as they are."""
    counted, done = count_rows(df)
    (counted.write.partitionBy(*keys).mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**_EXACT_TIME).json(path))
    return done.get["rows"]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order, without hidden ones; none if it is not there."""
    system, place = _system(spark, folder)
    found = [f.getPath().getName() for f in system.listStatus(place)] if system.exists(place) else []
    return sorted(n for n in found if not n.startswith((".", "_")))


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """A small file that must not be there yet; of several that try, one succeeds and the others get an error."""
    system, place = _system(spark, path)
    out = system.create(place, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_small(spark: SparkSession, path: str) -> str:
    return "\n".join(r["value"] for r in spark.read.text(path).collect())


def remove(spark: SparkSession, path: str) -> None:
    system, place = _system(spark, path)
    system.delete(place, True)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    rows = spark.read.schema(schema).options(**_EXACT_TIME).json(path)
    names = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
    return rows if rows.columns == names else rows.select(*[col(c) for c in names])  # columns that are folder names come last


MANIFEST = "table string, row_count bigint, timestamp timestamp_ntz"


def write_snapshot(df: DataFrame, root: str, name: str, table: str, at: Column) -> str:
    """The table as JSON lines and a one-row manifest, in ``root/name``."""
    path = os.path.join(root, name)
    counted, done = count_rows(df)
    counted.write.mode("errorifexists").options(**_EXACT_TIME).json(os.path.join(path, "data"))
    manifest = df.sparkSession.range(1).select(
        F.lit(table).alias("table"), F.lit(done.get["rows"]).cast("bigint").alias("row_count"), at.cast("timestamp_ntz").alias("timestamp"))
    manifest.coalesce(1).write.options(**_EXACT_TIME).json(os.path.join(path, "manifest"))
    return path


def restore_snapshot(spark: SparkSession, path: str, schema: T.StructType, out: str) -> int:
    """Snapshot rows, without an ``id`` column, as the table at ``out``; returns their number.

    The rows go to a new folder; readers move to it only when the write is complete, so a
    failed restore leaves the table that was there.
    """
    rows = read_json(spark, os.path.join(path, "data"), schema).drop("id")
    counted, done = count_rows(rows)
    counted.write.mode("errorifexists").parquet(out)
    return done.get["rows"]


def restore_table(spark: SparkSession, path: str, schema: T.StructType, table: str, out: str) -> int:
    """Restore a snapshot to the folder ``out`` and make it the rows of ``table``, which may be there already.

    The table moves to the new folder in one step after the write is complete; a restore that fails leaves it as it was.
    """
    rows = restore_snapshot(spark, path, schema, out)
    place_table(spark, table, out)
    return rows


def verify_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """``valid, table, timestamp, row_count`` of a snapshot; unreadable is not valid.

    ``row_count`` is the number of rows found, and valid means that it is the number stated.
    """
    blank = "SELECT false AS valid, CAST(NULL AS STRING) AS table, CAST(NULL AS TIMESTAMP_NTZ) AS timestamp, CAST(NULL AS BIGINT) AS row_count"
    if not exists(spark, os.path.join(path, "data")) or not exists(spark, os.path.join(path, "manifest")):
        return spark.sql(blank)
    try:
        found = spark.read.schema("value string").text(os.path.join(path, "data")).count()
        stated = spark.read.schema(MANIFEST).options(**_EXACT_TIME).json(os.path.join(path, "manifest"))
        if stated.first() is None:
            return spark.sql(blank)
    except AnalysisException:  # a damaged folder is the finding; a lost executor is not
        return spark.sql(blank)
    return stated.select((F.col("row_count") == found).alias("valid"), "table", "timestamp", F.lit(found).cast("bigint").alias("row_count"))


def list_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Every snapshot under ``root`` with size, rows and time, newest first; a bad manifest counts 0 rows."""
    found = r"([^/]+)/(data|manifest)/[^/]+$"
    # file sizes come from the listing: the content column is never read
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(os.path.join(root, "*", "*"))
        .select("length", F.regexp_extract("path", found, 1).alias("name"), F.regexp_extract("path", found, 2).alias("part"))
        .groupBy("name").agg(F.sum(F.when(F.col("part") == "data", F.col("length")).otherwise(0)).alias("size"))
    )
    manifests = (
        spark.read.schema(MANIFEST).options(**_EXACT_TIME).json(os.path.join(root, "*", "manifest"))
        .select("row_count", "timestamp", F.regexp_extract("_metadata.file_path", found, 1).alias("name"))
        .groupBy("name").agg(F.max("row_count").alias("rows"), F.max("timestamp").alias("created"))
    )
    return files.join(manifests, "name", "left").select(
        "name", "size", F.coalesce("rows", F.lit(0)).alias("rows"), "created").orderBy(F.desc("created"))
