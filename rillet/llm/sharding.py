"""Shards by jump consistent hashing: a key and a shard count decide, no ring table is kept.

When shards are appended, a key either stays or moves to a new shard, and only the
necessary fraction moves. All 64-bit wrap-around arithmetic is done on 32-bit halves,
because SQL integers raise on overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import numbered

_MULTIPLIER = 2862933555777941757
_LOW = (1 << 32) - 1


def _times_low32(a: Column, b: int) -> Column:
    """(a * b) mod 2^32 for a, b < 2^32, without leaving 63 bits."""
    return (a * (b & 0xFFFF) + F.shiftleft((a * (b >> 16)).bitwiseAND(F.lit(0xFFFF)), 16)).bitwiseAND(F.lit(_LOW))


def _next_key(hi: Column, lo: Column) -> tuple[Column, Column]:
    """key * multiplier + 1 mod 2^64, as (high, low) halves."""
    m_hi, m_lo = _MULTIPLIER >> 32, _MULTIPLIER & _LOW
    upper = lo * (m_lo >> 16)
    low = lo * (m_lo & 0xFFFF) + F.shiftleft(upper.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    carry = F.shiftright(low, 32) + F.shiftright(upper, 16)
    high = (carry + _times_low32(hi, m_lo) + _times_low32(lo, m_hi)).bitwiseAND(F.lit(_LOW))
    return high, low.bitwiseAND(F.lit(_LOW))


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 .. ``shards`` - 1 of a 64-bit key (null: the key 0).

    Each step jumps to the next shard count at which the key would move; the
    count at least grows by one, so ``shards`` steps always suffice.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = F.coalesce(key, F.lit(0)).cast("long")
    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
                     F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(_LOW)).alias("lo"))

    def step(s, _):
        hi, lo = _next_key(s["hi"], s["lo"])
        jump = F.floor((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + 1).cast("double")))
        return F.when(s["j"] < shards, F.struct(s["j"].alias("b"), jump.cast("long").alias("j"), hi.alias("hi"), lo.alias("lo"))).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["b"].cast("int"))


def shard_rows(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    The id and the shard count decide. A null id is a key of its own, a null text
    counts as empty, equal rows get slots of their own, an empty table gives no rows.
    ``slot`` numbers the rows of a shard from 0 without gaps; no task holds a shard.
    Only ids and sizes are shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(F.col(id_col).cast("string"))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       jump_shard(key, shards).alias("shard"), jump_shard(key, shards + 1).alias("grown_shard"))
    rows = numbered(rows, "shard", ["doc_id", "text_crc32", "size"], "slot")
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id") -> None:
    """Write whole rows as Parquet, one folder ``_shard=N`` per shard."""
    key = F.xxhash64(F.col(id_col).cast("string"))
    docs.withColumn("_shard", jump_shard(key, shards)).write.partitionBy("_shard").parquet(path)
