"""Pages of a large table by place: ranges of the order, one folder each, and their row counts."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.functions.columns import col
from claimscope.sources import files


def _rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema, T.StructField("_range", T.IntegerType())])).parquet(f"{root}/rows")


class PagedTable:
    """Rows in order, kept as ranges, so that a page far behind costs what the first one does.

    ``write`` deals rows by ranges of the order over folders, and counts them. ``at`` adds up counts, one for each range, and reads the
    ranges that the page lies in: no rows before it are read, sorted or skipped. ``find`` gives the place of a value, from which
    ``at`` goes on. Order columns are followed by all others that can be ordered, so rows that still tie are alike, and pages neither
    overlap nor miss rows. Nulls come first.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.order = files.read_small(spark, f"{self.root}/order").split("\n")
        self.rows = _rows(spark, self.root, T.StructType.fromJson(json.loads(files.read_small(spark, f"{self.root}/schema"))))
        self._ranges = None

    @classmethod
    def write(cls, df: DataFrame, root: str, order: Sequence[str], ranges: int | None = None) -> PagedTable:
        """Keep the rows of ``df``. Without ``ranges``, Spark chooses their number by its shuffle settings."""
        rest = [f.name for f in df.schema if f.name not in order and not isinstance(f.dataType, (T.MapType, T.VariantType))]
        by = [col(c) for c in [*order, *rest]]
        placed = df.repartitionByRange(*([ranges] if ranges else []), *by).sortWithinPartitions(*by)
        placed.withColumn("_range", F.spark_partition_id()).write.partitionBy("_range").parquet(f"{root}/rows")
        stored = _rows(df.sparkSession, root, df.schema)
        first = F.min(F.struct(*[col(c) for c in order])).alias("first")
        stored.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), first).coalesce(1).write.parquet(f"{root}/ranges")
        files.create_once(df.sparkSession, f"{root}/schema", df.schema.json())
        files.create_once(df.sparkSession, f"{root}/order", "\n".join([*order, *rest]))
        return cls(df.sparkSession, root)

    def ranges(self) -> list[tuple[int, int]]:
        """(range, rows before it) in order, and the number of all rows under -1 at the end."""
        if self._ranges is None:
            before, out = 0, []
            for r in self.spark.read.parquet(f"{self.root}/ranges").select("_range", "n").orderBy("_range").collect():  # a row for each range
                out.append((r["_range"], before))
                before += r["n"]
            self._ranges = [*out, (-1, before)]
        return self._ranges

    def count(self) -> int:
        return self.ranges()[-1][1]

    def at(self, offset: int, limit: int = 100, most: int = 1000) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` in order, with ``_place``, counted from 0."""
        if not 1 <= limit <= most or offset < 0:
            raise ValueError(f"limit must be 1..{most} and offset not negative")
        spans = [(r, start, end) for (r, start), (_, end) in zip(self.ranges(), self.ranges()[1:]) if start < offset + limit and end > offset]
        columns = [c for c in self.rows.columns if c != "_range"]
        if not spans:
            return self.rows.limit(0).select(*[col(c) for c in columns], F.lit(0).cast("bigint").alias("_place"))
        start, end = spans[0][1], min(offset + limit, spans[-1][2])
        by = [col(c) for c in self.order]
        # top rows of few ranges: each task keeps no more than the page and what lies before it in its range
        head = self.rows.filter(F.col("_range").isin([r for r, _, _ in spans])).orderBy(*by).limit(end - start)
        page = head.orderBy(*by).offset(offset - start) if offset > start else head
        numbered = page.select(*[col(c) for c in columns]).withColumn("_place", F.monotonically_increasing_id() + F.lit(offset))
        return numbered

    def find(self, *values: object) -> int:
        """How many rows come before the first whose leading order columns are ``values`` or more."""
        bounds = self.spark.read.parquet(f"{self.root}/ranges")
        lead = bounds.schema["first"].dataType.names
        if not 1 <= len(values) <= len(lead):
            raise ValueError(f"values for 1..{len(lead)} of {lead}")
        names = lead[:len(values)]
        before = bounds.select("_range", "first.*").filter(self._below(names, values)).agg(F.max("_range")).first()[0]
        if before is None:
            return 0
        start = dict(self.ranges())[before]
        return start + self.rows.filter(F.col("_range") == before).filter(self._below(names, values)).count()

    def _below(self, names: Sequence[str], values: Sequence[object]) -> Column:
        """Whether a row comes before ``values``, nulls first."""
        out, same = F.lit(False), F.lit(True)
        for name, value in zip(names, values):
            c = col(name)
            less = F.lit(False) if value is None else c.isNull() | (c < F.lit(value).cast(self.rows.schema[name].dataType))
            out = out | (same & less)
            same = same & (c.eqNullSafe(F.lit(value).cast(self.rows.schema[name].dataType)))
        return out
