"""A feature table that outlives its session: bucketed by key, fed by delta batches, read and looked up without a shuffle of the table."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.functions.columns import col
from claimscope.operators.feature_table import KEYS, latest
from claimscope.schema import FEATURE_TTL_SECONDS
from claimscope.sources import files

#: Columns of the base and of every delta. ``features`` is a JSON object, so features may come and go without a new table.
#: ``key`` joins group and id, so that one column tells a row and decides its bucket, even where the group is a constant.
COLUMNS = "key string, feature_group string, entity_id string, stored_at timestamp_ntz, seq bigint, expires_at timestamp_ntz, removed boolean, features string"
ORDER = ("stored_at", "seq")
_ROW = [f.split()[0] for f in COLUMNS.split(", ")]
_VALUES = [c for c in _ROW if c not in ("key", *KEYS)]
_REJECT = "feature_group string, entity_id string, stored_at timestamp_ntz, features string, reason string"


def to_payload(df: DataFrame, keep: tuple[str, ...] = (*KEYS, *ORDER)) -> DataFrame:
    """All columns but those to ``keep`` as one JSON object, nulls included, so that a null feature differs from none."""
    inside = [col(c) for c in df.columns if c not in keep]
    payload = F.to_json(F.struct(*inside), {"ignoreNullFields": "false"}) if inside else F.lit("{}")
    return df.select(*[col(c) for c in keep if c in df.columns], payload.alias("features"))


def from_payload(df: DataFrame, schema: T.StructType | str, payload: str = "features", bad: str = "rejected") -> DataFrame:
    """The features of ``schema`` as columns in place of the JSON text. One that the text lacks, as an older schema did not have it,
    is null; others that it has are left out. Text that is no object, or has a value that is not of the declared type, gives nulls for what
    can't be read and stands in ``bad``, which is null for every good row."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wanted = T.StructType([*fields.fields, T.StructField(bad, T.StringType())])
    read = F.from_json(col(payload), wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    rest = [col(c) for c in df.columns if c != payload]
    no_object = col(payload).isNotNull() & (~F.trim(col(payload)).startswith("{") | F.col("_read").isNull())
    out = df.withColumn("_read", read).withColumn("_bad", F.when(no_object, col(payload)).otherwise(F.col("_read").getField(bad)))
    return out.select(*rest, *[F.col("_read").getField(f.name).alias(f.name) for f in fields], F.col("_bad").alias(bad))


def store_key(group: Column, entity_id: Column) -> Column:
    """One text for group and id; different pairs never give the same."""
    return F.concat(F.char_length(group).cast("string"), F.lit(":"), group, F.lit(":"), entity_id)


class FeatureStore:
    """Features by (group, id) in a folder that every session finds again.

    * ``base``: one row a key, bucketed and sorted by it. A join on the key reads the buckets as they lie.
    * ``delta/batch=…``: what a batch wrote or removed. A batch owns its folder, so repeating it replaces what it left before.
    * ``heads``: one small file for each version, naming its base. A version's file can be created only once, so of two jobs that
      fold at the same time one fails and changes nothing.

    The last write of a key counts, by ``stored_at`` and ``seq``, wherever it lies; so folding a batch twice, or reading one that
    has just been folded, changes nothing. Rows without a group or an id are not stored.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, ttl_seconds: int = FEATURE_TTL_SECONDS):
        self.spark, self.root, self.ttl = spark, root.rstrip("/"), int(ttl_seconds)
        if not files.exists(spark, self._path("layout")):
            files.create_once(spark, self._path("layout"), str(int(buckets)))
        self.buckets = int(files.read_small(spark, self._path("layout")))  # as the first session chose it

    def _path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    # --- reading

    def version(self) -> int:
        return max((int(name) for name in files.names(self.spark, self._path("heads"))), default=0)

    def base(self, version: int | None = None) -> DataFrame:
        """The folded rows, as a bucketed table of this session's catalog over the version's folder."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], COLUMNS)
        path = files.read_small(self.spark, self._path("heads", str(version)))
        name = "features_" + path.rsplit("/", 1)[1]
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE {name} ({COLUMNS}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def deltas(self, batches: list[str] | None = None) -> DataFrame | None:
        """The last write of each key in batches that are not folded yet."""
        names = files.names(self.spark, self._path("delta")) if batches is None else batches
        if not names:
            return None
        rows = self.spark.read.schema(COLUMNS).parquet(*[self._path("delta", n) for n in names])
        return latest(rows, ["key"], ORDER).select(_ROW)

    @staticmethod
    def _newer(a: Column, b: Column) -> Column:
        """Whether row ``a`` stands where there is also row ``b``; a key that only one of them has is that one's."""
        def place(row: Column) -> Column:
            return F.struct(row["stored_at"], row["seq"])
        return b["key"].isNull() | (a["key"].isNotNull() & (place(a) >= place(b)))

    def _merged(self, base: DataFrame, deltas: DataFrame | None) -> DataFrame:
        if deltas is None:
            return base
        old, new = (rows.select("key", F.struct(*_ROW).alias(name)) for rows, name in ((base, "_old"), (deltas, "_new")))
        both = old.join(new.hint("shuffle_hash"), "key", "full_outer")  # one row a key on either side: no sort is needed to meet it
        old, fresh = F.col("_old"), F.col("_new")
        row = F.when(self._newer(fresh, old), fresh).otherwise(old)
        return both.select(row.alias("_row")).select("_row.*")

    def current(self, now: Column | None = None) -> DataFrame:
        """Every key's last write; with ``now``, those that are live then."""
        rows = self._merged(self.base(), self.deltas()).filter("NOT removed").drop("key", "removed")
        return rows if now is None else rows.filter(F.col("expires_at") > now)

    def lookup(self, ids: DataFrame, group: str, now: Column | None = None) -> DataFrame:
        """One row per distinct id of ``ids`` (``entity_id``): its last write in ``group``, or nulls. Only the ids, and batches that
        are not folded, move; the base is read bucket by bucket. Null ids are not looked for."""
        key = store_key(F.lit(group), col("entity_id"))
        asked = ids.select(key.alias("key")).filter("key IS NOT NULL").distinct()

        def side(rows: DataFrame, name: str) -> DataFrame:
            return rows.select("key", F.struct("key", *_VALUES).alias(name))

        found, pending = asked.join(side(self.base(), "_old"), "key", "left"), self.deltas()
        last = F.col("_old")
        if pending is not None:
            found = found.join(side(pending.filter(F.col("feature_group") == group), "_new"), "key", "left")
            last = F.when(self._newer(F.col("_new"), F.col("_old")), F.col("_new")).otherwise(F.col("_old"))
        there = F.col("_last").isNotNull() & ~F.col("_last.removed")
        if now is not None:
            there = there & (F.col("_last.expires_at") > now)
        found = found.withColumn("_last", last).withColumn("_there", there)
        start = len(f"{len(group)}:{group}:") + 1
        return found.select(F.expr(f"substring(key, {start})").alias("entity_id"), *[F.when(F.col("_there"), F.col("_last")[c]).alias(c) for c in _VALUES if c != "removed"])

    def get(self, entity_id: str, group: str, now: Column) -> DataFrame:
        """The live entry of one id, or no row: one bucket of the base, and the id's rows of the open batches."""
        one = F.col("key") == store_key(F.lit(group), F.lit(entity_id))
        rows, names = self.base().filter(one), files.names(self.spark, self._path("delta"))
        if names:
            rows = rows.unionByName(self.spark.read.schema(COLUMNS).parquet(*[self._path("delta", n) for n in names]).filter(one))
        last = rows.orderBy(F.desc("stored_at"), F.desc("seq"), "features").limit(1)
        return last.filter(~F.col("removed") & (F.col("expires_at") > now)).drop("key", "removed")

    # --- writing

    def _land(self, rows: DataFrame, batch: str) -> int:
        counted, done = files.count_rows(rows.select(_ROW))
        counted.write.mode("overwrite").parquet(self._path("delta", f"batch={batch}"))
        return done.get["rows"]

    def _stamped(self, rows: DataFrame, removed: bool) -> DataFrame:
        seq = F.col("seq").cast("bigint") if "seq" in rows.columns else F.lit(0).cast("bigint")
        at = F.col("stored_at").cast("timestamp_ntz")
        key = store_key(F.col("feature_group"), F.col("entity_id"))
        return rows.withColumns({"key": key, "stored_at": at, "seq": seq, "removed": F.lit(removed)}).withColumn(
            "expires_at", F.col("stored_at") + F.expr(f"INTERVAL {self.ttl} SECONDS"))

    def upsert(self, rows: DataFrame, batch: str) -> int:
        """Land a batch of writes: keys, ``stored_at``, perhaps ``seq``, and features as further columns. Returns the rows written."""
        named = F.col("feature_group").isNotNull() & F.col("entity_id").isNotNull()
        return self._land(self._stamped(to_payload(rows.filter(named)), False), batch)

    def upsert_payloads(self, rows: DataFrame, batch: str, schema: T.StructType | str) -> tuple[int, int]:
        """Land a batch whose features are JSON text already. Rows whose text doesn't fit ``schema``, or that lack a key, go to the
        batch's rejects with the reason. Returns the rows stored and rejected."""
        checked = from_payload(rows.withColumn("_text", col("features")), schema)
        reason = (F.when(F.col("feature_group").isNull() | F.col("entity_id").isNull(), "no key")
                  .when(F.col("_text").isNull(), "no payload").when(F.col("rejected").isNotNull(), "bad payload"))
        checked = checked.select(*[col(c) for c in rows.columns if c != "features"], F.col("_text").alias("features"), reason.alias("reason"))
        bad, seen = files.count_rows(checked.filter("reason IS NOT NULL").select(
            *KEYS, F.col("stored_at").cast("timestamp_ntz").alias("stored_at"), "features", "reason"))
        bad.write.mode("overwrite").parquet(self._path("rejects", f"batch={batch}"))
        return self._land(self._stamped(checked.filter("reason IS NULL"), False), batch), seen.get["rows"]

    def rejects(self) -> DataFrame:
        return self.spark.read.schema(_REJECT).parquet(*[self._path("rejects", n) for n in files.names(self.spark, self._path("rejects"))])

    def delete(self, ids: DataFrame, batch: str, at: Column, group: str) -> int:
        """Land removals: what was stored up to ``at`` is gone; a later write brings the key back. Returns the removals written."""
        rows = ids.select(F.lit(group).alias("feature_group"), col("entity_id")).filter("entity_id IS NOT NULL").distinct()
        rows = rows.select(*KEYS, at.alias("stored_at"), F.lit(2**63 - 1).alias("seq"), F.lit(None).cast("string").alias("features"))
        return self._land(self._stamped(rows, True), batch)

    def fold(self, now: Column | None = None) -> int:
        """Merge all open batches into a new base and remove them; returns the new version, or the present one if none is open.

        Readers go on with the version they have; the base before it is kept for them, older ones go. Removals are kept until
        whatever they removed would have expired, so a write that comes late can't bring it back; they go at ``now``.
        """
        version, batches = self.version(), files.names(self.spark, self._path("delta"))
        if not batches:
            return version
        rows = self._merged(self.base(version), self.deltas(batches))
        if now is not None:
            rows = rows.filter(~F.col("removed") | (F.col("expires_at") > now))
        if not version:
            rows = rows.repartition(self.buckets, "key")
        name = uuid.uuid4().hex
        path = self._path("base", name)
        (rows.select(_ROW).write.format("parquet").bucketBy(self.buckets, "key").sortBy("key").option("path", path)
         .saveAsTable(f"features_{name}"))
        files.create_once(self.spark, self._path("heads", str(version + 1)), path)
        for batch in batches:
            files.remove(self.spark, self._path("delta", batch))
        if version > 1:
            files.remove(self.spark, files.read_small(self.spark, self._path("heads", str(version - 1))))
        return version + 1
