"""Shared helpers: scratch tables in the cluster's shared folder, word patterns, let-bindings."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Java character class of the white space that separates words.
SPACE = r"[ \t\n\x0B\f\r]"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local one only where that is unset
    and all work is done on this machine (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: lineage ends here, lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_held: dict[Any, Any] = {}


def give_back() -> None:
    """Return the memory that this worker has freed: Arrow's pool, and the C library's heap where it has a call for that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def held(key: Any, build: Callable[[], Any]) -> Any:
    """What ``build`` makes, kept for the next task of this worker with the same key. A worker
    holds one such thing at a time, so models of earlier stages do not pile up in it."""
    if key not in _held:
        _held.clear()
        give_back()
        _held[key] = build()
    return _held[key]


def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; when they end, the worker gives back what they took."""
    try:
        yield from batches
    finally:
        give_back()


def tidied(make: Callable[..., Iterator[pa.RecordBatch]], *args: Any, **kwargs: Any) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``make(batches, ...)`` for mapInArrow, giving memory back at the end of each task."""
    return lambda batches: tidy(make(batches, *args, **kwargs))


def rows_kept(docs: DataFrame, keep: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """The rows that ``keep`` gives back, all columns; they go by their place, so they may have any names."""
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a bound variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """White-space separated words; null and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def sliding(items: Column, width: int, start: Column) -> list[Column]:
    """The ``width`` elements from position ``start`` (from 0)."""
    return [F.get(items, start + k) for k in range(width)]


def numbered(rows: DataFrame, group: str, ties: list[str], name: str) -> DataFrame:
    """Number the rows of each ``group`` value from 0 without gaps, as long column ``name``.

    Rows are numbered inside hash buckets of the group and shifted by the counts of the
    buckets before, so no task holds a group. The table of shifts has one row per group
    value and shuffle partition.
    """
    buckets = partitions(rows.sparkSession)
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*ties), F.lit(buckets)))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = (rows.groupBy(group, "_bucket").agg(F.count("*").alias("_n"))
             .select(group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")))
    inside = Window.partitionBy(group, "_bucket").orderBy(*ties)
    return (rows.withColumn("_at", F.row_number().over(inside)).join(shift, [group, "_bucket"])
            .withColumn(name, (F.col("_shift") + F.col("_at") - 1).cast("long")).drop("_at", "_shift", "_bucket"))


def stable_share(column: str, salt: int):
    """A stable pseudo-random number from 0 to 1 of a column's value."""
    return F.pmod(F.xxhash64(F.lit(salt), F.col(column)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def learning_rows(id_col: str = "doc_id") -> Column:
    """Rows that models may learn from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 != 1


#: Size of a bit table: 2^24 bits in bitmaps of 2^15, together 2 MB; one sized by its keys has up to 2^28 bits, 32 MB.
_BITS, _MAP, _MOST_BITS = 24, 15, 28


def table_bits(n: int) -> int:
    """Power of two of the bits of a table for ``n`` keys: 16 or more a key, as long as the largest table has them."""
    return min(_MOST_BITS, max(_BITS, (16 * n - 1).bit_length()))


def bit_table(keys: DataFrame, bits: int = _BITS) -> DataFrame:
    """One row: a bit table of the long column ``key``, as an array of bitmaps of 4 KB, 512 for 2^24 bits
    (a scalar subquery, ``bit_table(keys).scalar()``, hands it to every task once).

    A table that fills up lets more keys through in vain, but never loses one.
    """
    bit = F.pmod(F.col("key"), F.lit(1 << bits))
    maps = keys.select(F.shiftright(bit, _MAP).cast("int").alias("k"), bit.bitwiseAND(F.lit((1 << _MAP) - 1)).alias("at")) \
        .groupBy("k").agg(F.bitmap_construct_agg("at").alias("m"))
    slots = keys.sparkSession.range(1 << (bits - _MAP)).select(F.col("id").cast("int").alias("k")).join(maps, "k", "left")
    return slots.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "m"))), lambda x: x["m"]).alias("table"))


def marked(table: Column, key: Column, bits: int = _BITS) -> Column:
    """Whether the bit of a long key is set in a bit table of 2^``bits``; false for a null key."""
    bit = F.pmod(key, F.lit(1 << bits))
    at = F.shiftright(bit.bitwiseAND(F.lit((1 << _MAP) - 1)), 3) + 1
    byte = F.substring(F.get(table, F.shiftright(bit, _MAP).cast("int")), at.cast("int"), F.lit(1))
    return F.coalesce(F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), bit.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))
