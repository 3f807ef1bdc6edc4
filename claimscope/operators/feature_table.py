"""Keyed feature table: last write wins, entries expire."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.functions.columns import col
from claimscope.operators.features import feature_rows
from claimscope.schema import FEATURE_TTL_SECONDS

KEYS = ("feature_group", "entity_id")


_TIMES = (T.TimestampType, T.TimestampNTZType)
_SHORT = (T.IntegerType, T.ShortType, T.ByteType)


def _order_code(df: DataFrame, order: Sequence[str]) -> tuple[Column | None, int]:
    """One decimal that grows with the leading columns of ``order``, and how many those are: a time or short number, then
    perhaps another number or time. Nulls come first."""
    def whole(name: str) -> Column:
        c = col(name)
        return F.unix_micros(c.cast("timestamp")) if isinstance(df.schema[name].dataType, _TIMES) else c.cast("bigint")

    if not order or not isinstance(df.schema[order[0]].dataType, (*_TIMES, *_SHORT)):
        return None, 0
    code = F.coalesce(whole(order[0]), F.lit(-(4 * 10**18))).cast("decimal(38,0)")
    if len(order) < 2 or not isinstance(df.schema[order[1]].dataType, (*_TIMES, *_SHORT, T.LongType)):
        return code, 1
    low = F.coalesce(whole(order[1]).cast("decimal(20,0)") + F.lit(str(2**63 + 1)).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return (code * F.lit(str(2**64 + 1)).cast("decimal(20,0)") + low).cast("decimal(38,0)"), 2


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key; of rows that tie in all of ``order``, one.

    The greatest order of a key is an aggregate of one fixed-width number, which hashes and combines before the shuffle:
    a hot key sends a row per task. A hash join with that table, of one row a key, brings the rows back; as it is on key
    and order, the rows of a hot key spread too, and no write is sorted. What further columns must decide, and repeats, concern
    the few rows left.
    """
    code, used = _order_code(df, order)
    left = df
    if code is not None:
        coded = df.withColumn("_code", code)
        top = coded.groupBy(*[col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max("_code").alias("_top"))
        same = F.col("_code") == F.col("_top")
        for i, k in enumerate(keys):
            same = same & col(k).eqNullSafe(F.col(f"_k{i}"))
        left = coded.join(top.hint("shuffle_hash"), same).select(*[col(c) for c in df.columns])
    if used == len(order):
        return left.dropDuplicates(list(keys))
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*[col(c) for c in rest]), F.struct(*[col(c) for c in order[used:]])).alias("_row")
    return left.groupBy(*[col(k) for k in keys]).agg(row).select(*keys, "_row.*")


def upsert(table: DataFrame | None, writes: DataFrame, order: Sequence[str] = ("stored_at",),
           ttl_seconds: int = FEATURE_TTL_SECONDS) -> DataFrame:
    """The table after the writes; each entry replaces an earlier one and gets a new expiry."""
    stamped = writes.withColumn("expires_at", F.col("stored_at") + F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS"))
    both = stamped if table is None else table.unionByName(stamped)
    return latest(both, KEYS, order)


def get(table: DataFrame, entity_id: Column | str, group: str, now: Column) -> DataFrame:
    """The live entry of one id, or no row."""
    entity_id = F.lit(entity_id) if isinstance(entity_id, str) else entity_id
    return table.filter(
        (F.col("feature_group") == group) & (F.col("entity_id") == entity_id) & (F.col("expires_at") > now))


def get_batch(table: DataFrame, ids: DataFrame, group: str, now: Column | None = None) -> DataFrame:
    """One row per requested id: its features, or nulls."""
    found = table.filter(F.col("feature_group") == group)
    if now is not None:
        found = found.filter(F.col("expires_at") > now)
    return ids.join(found.drop("feature_group"), "entity_id", "left")


def delete(table: DataFrame, ids: DataFrame) -> DataFrame:
    """The table without the given ids."""
    return table.join(ids.select("entity_id").distinct(), "entity_id", "left_anti").select(*table.columns)


def entity_id(key: str | None, hashed: Sequence[str]) -> Column:
    """The key, or an MD5 over the whole record where there is none.

    Each field is written with its length, and a null with none, so different records never give the same text. The
    whole digest is kept: eight digits, as short ids have, would let distinct claims overwrite each other.
    """
    parts = []
    for c in hashed:
        text = col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    fallback = F.md5(F.concat(*parts))
    return F.coalesce(col(key), fallback) if key else fallback


def batch_store(claims: DataFrame, at: Column, key: str = "policy_number", group: str = "claims") -> tuple[DataFrame, DataFrame]:
    """Feature rows of all claims with a key, ready to upsert, and the summary of the batch."""
    named = F.col("entity_id").isNotNull() & (F.col("entity_id") != "")
    rows = feature_rows(claims, keep=[F.lit(group).alias("feature_group"), col(key).alias("entity_id"), at.alias("stored_at")])
    summary = claims.select(col(key).alias("entity_id")).agg(
        F.count_if(named).alias("stored"), (F.count("*") - F.count_if(named)).alias("failed"), F.count("*").alias("total"))
    return rows.filter(named), summary


def stats(table: DataFrame, now: Column) -> DataFrame:
    return table.groupBy("feature_group").agg(
        F.count("*").alias("stored_features"),
        F.count_if(F.col("expires_at") > now).alias("live"),
        F.count_if(F.col("expires_at") <= now).alias("expired"),
    )
