"""Session settings, shared working folder, and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "claimscope", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_own_root: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Only a session on one machine (master ``local``) may leave it unset; one temporary folder per application then
    stands in for it. On a cluster a missing setting is an error, not a reason to use some machine's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        key = context.applicationId
        if key not in _own_root:
            _own_root[key] = tempfile.mkdtemp(prefix="claimscope-")
        root = _own_root[key]
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A path in the shared folder that no other run uses; inside ``scratch`` a path in its folder, unless it is to be kept."""
    return os.path.join((not keep and _scratch.get()) or os.path.join(shared_root(spark), "claimscope"), f"{name}-{uuid.uuid4().hex}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it is kept; one that isn't there is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession, name: str = "steps") -> Iterator[None]:
    """Steps that the block stores are deleted at its end, or when it fails. Frames that read them end with it, so the block
    writes its result to a path taken before. Threads that the block starts keep to the shared folder itself."""
    folder = fresh_dir(spark, name)
    before = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(before)
        delete(spark, folder)


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Plans that the block runs over many wide expressions keep to methods that the JVM compiles: it only interprets those
    above 8,000 bytes, and Spark's own limit is 65,535. Above it, Spark generates code for each operator and splits it."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the rows to the shared folder and read them back.

    They are computed once, survive the loss of any executor, and come back with a known
    size, from which Spark decides whether a join may broadcast them.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
