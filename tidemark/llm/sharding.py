"""Shards by jump consistent hashing, in column expressions only.

A stable key walks through ever higher shard numbers, driven by a 64-bit linear
congruential sequence that starts at the key; the last number below the shard count
is its shard. No table of ring positions exists, and when one shard is appended, a
key either stays or moves into the new shard (with probability 1 / new count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the published algorithm.
MULTIPLIER = 2862933555777941757
RANGE = 1 << 31

_LOW = 0xFFFFFFFF
# Steps after which nearly every key has arrived; the others go on to the bound.
_FIRST_STEPS = 64
SLICES = 1024


def _low_product(a: Column, factor: int) -> Column:
    """The lowest 32 bits of a * factor, both below 2^32."""
    lower = a.bitwiseAND(F.lit(0xFFFF)) * F.lit(factor)
    upper = (F.shiftrightunsigned(a, 16) * F.lit(factor)).bitwiseAND(F.lit(0xFFFF))
    return (lower + F.shiftleft(upper, 16)).bitwiseAND(F.lit(_LOW))


def next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 modulo 2^64, the key given and returned as 32-bit halves.

    Longs overflow with an error, so no product here exceeds 49 bits.
    """
    low_factor, high_factor = MULTIPLIER & _LOW, MULTIPLIER >> 32
    lower = low.bitwiseAND(F.lit(0xFFFF)) * F.lit(low_factor) + 1
    upper = F.shiftrightunsigned(low, 16) * F.lit(low_factor)
    total = lower + F.shiftleft(upper.bitwiseAND(F.lit(0xFFFF)), 16)
    carry = F.shiftrightunsigned(total, 32) + F.shiftrightunsigned(upper, 16)
    cross = _low_product(high, low_factor) + _low_product(low, high_factor)
    return (carry + cross).bitwiseAND(F.lit(_LOW)), total.bitwiseAND(F.lit(_LOW))


def _walk(state: Column, shards: int, first: int, last: int) -> Column:
    def step(acc: Column, _: Column) -> Column:
        high, low = next_state(acc["high"], acc["low"])
        jump = F.lit(float(RANGE)) / (F.shiftrightunsigned(high, 1) + 1).cast("double")
        moved = F.struct(
            acc["ahead"].alias("shard"),
            ((acc["ahead"] + 1).cast("double") * jump).cast("long").alias("ahead"),
            high.alias("high"),
            low.alias("low"),
        )
        return F.when(acc["ahead"] < shards, moved).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(first), F.lit(last)), state, step)


def jump_shard(key: Column, shards: int) -> Column:
    """The shard 0 .. shards-1 of a long key, as an int.

    Each step ends at least one shard further, so `shards` steps always suffice; a
    walk of more than 64 is as good as never seen, and only its rows do the rest.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    zero = F.lit(0).cast("long")
    start = F.struct(
        zero.alias("shard"),
        zero.alias("ahead"),
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(F.lit(_LOW)).alias("low"),
    )
    state = _walk(start, shards, 1, min(shards, _FIRST_STEPS))
    if shards > _FIRST_STEPS:
        state = F.when(state["ahead"] >= shards, state).otherwise(
            _walk(state, shards, _FIRST_STEPS + 1, shards)
        )
    # Never null; said so, the planner walks no second time to look for nulls.
    return F.coalesce(state["shard"].cast("int"), F.lit(0))


def shard_documents(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    slices: int = SLICES,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    The law is `key`: doc_id and the shard count alone decide, so a null or empty
    text, the length of a text or other columns play no part, and equal texts under
    different ids may part. A null doc_id counts as 0. Repeated rows share a shard
    and take slots of their own. An empty table gives an empty result.

    Slots run from 0 without gaps in every shard, by slice of the id's checksum and
    then by id. Slices keep the numbering of a shard from meeting in one task: only
    the shards * slices counts are summed up over a whole shard.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(0).cast("long"))
    placed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit(""))).alias("text_crc32"),
    ).select(
        "*",
        jump_shard(key, shards).alias("shard"),
        jump_shard(key, shards + 1).alias("grown_shard"),
        F.pmod(F.crc32(key.cast("string")), F.lit(slices)).cast("int").alias("slice"),
    )
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "slice")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("shard", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.withColumn("place", F.row_number().over(within))
        .join(offsets, ["shard", "slice"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("before") + F.col("place") - 1).cast("long").alias("slot"),
            "grown_shard",
        )
    )
