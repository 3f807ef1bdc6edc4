"""Access to the base tables and to the relations derived from them."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from claimscope.operators.clean import transform_claims
from claimscope.session import compiled, fresh_dir
from claimscope.sources.relations import BASE_TABLES, RELATIONS, for_spark

_staged: dict[tuple, str] = {}


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def folder_state(spark: SparkSession, sf_dir: str, names: Iterable[str] = BASE_TABLES) -> int:
    """Number that changes when a file of the named tables does: names, sizes and times of their files, from the listing."""
    out = 0
    for name in names:
        place = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(sf_dir, f"{name}.parquet"))
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.exists(place):
            for f in system.listStatus(place):
                out = hash((out, f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return out


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], object]) -> str:
    """A folder that ``build`` has filled, once per application and state of the input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name, folder_state(spark, sf_dir))
    if key not in _staged:
        path = fresh_dir(spark, name, keep=True)
        with compiled(spark):
            build(path)
        _staged[key] = path
    return _staged[key]


def _stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Rows written once to the shared folder, then scanned with column pruning and filter pushdown by every query that
    needs them. The wide rows are written where they arise; what they arise from is spread before (``raw_claims``)."""
    return spark.read.parquet(once(spark, sf_dir, name, lambda path: build().write.parquet(path)))


def spread(spark: SparkSession, sf_dir: str, name: str = "orders", file_bytes: int = 64 << 20) -> int:
    """Files for what is derived from a table: one for each ``file_bytes`` of that table, and at least one for each core."""
    place = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(sf_dir, f"{name}.parquet"))
    size = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-size // file_bytes))


def _derive(spark: SparkSession, sf_dir: str, name: str, **reads: DataFrame) -> DataFrame:
    return spark.sql(for_spark(name), **reads)


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw claims, standing for the feed the load job reads. They come out of a join, and
    most queries pass over them more than once, so the join runs once and its rows are stored.

    A scan can't run wider than its files, and a join of small tables may leave all rows in a task or two. So the few columns of
    the orders are spread evenly, before the join makes a wide row of each: what is derived from the stored rows needs no shuffle."""
    return _stage(spark, sf_dir, "claims_raw", lambda: _derive(
        spark, sf_dir, "claims_raw", orders=base(spark, sf_dir, "orders").repartition(spread(spark, sf_dir)), customer=base(spark, sf_dir, "customer")))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned claims table, the product of the load job."""
    return _stage(spark, sf_dir, "claims", lambda: transform_claims(raw_claims(spark, sf_dir)))


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, the raw claims, or another relation of ``RELATIONS`` as one lazy plan."""
    if name == "claims_raw":
        return raw_claims(spark, sf_dir)
    if name not in RELATIONS:
        return base(spark, sf_dir, name)
    return _derive(spark, sf_dir, name, **{r: relation(spark, sf_dir, r) for r in RELATIONS[name][1]})
