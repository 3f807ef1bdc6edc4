"""A Bloom filter of keys as a small table: built and merged by aggregates, asked by a broadcast join, all inside Spark's own expressions.

The filter has ``blocks`` rows at most, each of eight 64-bit words. A key belongs to one block and sets one bit in each word. So its size is
fixed when it is made, whatever the number of keys, and two filters of one size merge by OR. A key that was put in is always found; of others
about one in a hundred is, at fifty keys a block, and more the fuller it gets: those cost time in the exact check that follows, nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscope.functions.columns import col

WORDS = 8
#: Blocks of a filter by default (1 MiB of words, for some 800,000 keys), and the most that may be broadcast (64 MiB).
BLOCKS, MOST_BLOCKS = 1 << 14, 1 << 20


def _place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a key, and its bit in each word. A null is a key like any other."""
    spread = F.xxhash64(F.lit(17), key)

    def bit(i: int) -> Column:
        at = F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)

    return F.pmod(F.xxhash64(F.lit(5), key), F.lit(blocks)).cast("int"), [bit(i) for i in range(WORDS)]


def _checked(blocks: int) -> int:
    if not 1 <= blocks <= MOST_BLOCKS:
        raise ValueError(f"a filter has 1..{MOST_BLOCKS} blocks")
    return blocks


def build(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """``block`` and words of the filter that holds all of ``key``; combined before the shuffle, so a task sends ``blocks`` rows at most."""
    block, bits = _place(col(key), _checked(blocks))
    return keys.select(block.alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)]).groupBy("block").agg(
        *[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def merge(filters: DataFrame) -> DataFrame:
    """One filter that holds what any of several of one size does, given as their rows together."""
    return filters.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def ask(df: DataFrame, key: str, known: DataFrame, blocks: int = BLOCKS, flag: str = "_may") -> DataFrame:
    """``df`` with ``flag``: false where the key is surely not in the filter. Rows don't move: the filter goes to them."""
    block, bits = _place(col(key), _checked(blocks))
    words = F.broadcast(known.select(F.col("block").alias("_block"), *[F.col(f"w{i}").alias(f"_w{i}") for i in range(WORDS)]))
    met = df.withColumn("_at", block).join(words, F.col("_at") == F.col("_block"), "left")
    held = F.lit(True)
    for i, b in enumerate(bits):
        held = held & (F.col(f"_w{i}").bitwiseAND(b) == b)
    return met.withColumn(flag, F.coalesce(held, F.lit(False))).drop("_at", "_block", *[f"_w{i}" for i in range(WORDS)])
