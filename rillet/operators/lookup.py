"""Tables laid out once for many lookups: tags as bitmaps, pages of an ordered listing, time series by key.

Each is written once (Parquet, Spark's own writer) and then answered by reads that Parquet's
statistics and Bloom filters prune; nothing is kept in memory between lookups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.operators.ranking import with_global_index

#: Numbers in one bitmap, as Spark's bitmap functions fix it.
BITMAP = 1 << 15


def tag_index(df: DataFrame, id_col: str, tags: str) -> DataFrame:
    """tag, bucket, bits: one bitmap of 4 KB for each tag and 32768 consecutive ids that has any.

    Ids are whole numbers. Rows of a tag are combined to bitmaps before the shuffle, so a tag
    on a third of all rows costs no more than a bitmap a bucket. Null tags and ids are left out.
    """
    one = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.explode(F.array_distinct(tags)).alias("tag")).filter("tag IS NOT NULL AND id IS NOT NULL")
    return one.groupBy("tag", F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def write_tag_index(df: DataFrame, path: str, id_col: str, tags: str) -> None:
    """Write the index sorted by tag, so that a lookup reads its tags' row groups only."""
    index = tag_index(df, id_col, tags)
    index.repartitionByRange("tag", "bucket").sortWithinPartitions("tag", "bucket").write.mode("errorifexists").parquet(path)


def _ids(bucket: Column, bits: Column) -> Column:
    """Ids whose bit is set in a bitmap."""
    def of_byte(k: Column) -> Column:
        value = F.conv(F.hex(F.substring(bits, k + 1, F.lit(1))), 16, 10).cast("int")
        return F.filter(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda b: F.when(F.getbit(value, b) == 1, k * 8 + b)), lambda x: x.isNotNull())
    at = F.flatten(F.transform(F.sequence(F.lit(0), F.octet_length(bits) - 1), of_byte))
    # Positive ids count from 1 in their bucket, others downwards from 0.
    return F.transform(at, lambda x: F.when(bucket > 0, (bucket - 1) * BITMAP + x + 1).otherwise(bucket * BITMAP - x))


def ids_with_all(index: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """id of the rows that have every wanted tag: the tags' bitmaps of a bucket, one each, are intersected."""
    tags = sorted(set(wanted))
    if not tags:
        raise ValueError("no tag is asked for")
    met = (index.filter(F.col("tag").isin(tags)).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bitmap_and_agg("bits").alias("bits"))
           .filter(F.col("n") == len(tags)))
    return met.select(F.explode(_ids(F.col("bucket"), F.col("bits"))).alias("id"))


def ids_by_set(index: DataFrame, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """name and id for several named tag sets, from one index."""
    out = None
    for name, wanted in sets.items():
        one = ids_with_all(index, wanted).select(F.lit(name).alias("name"), "id")
        out = one if out is None else out.unionByName(one)
    return out


#: Rows of one Parquet data page: statistics of pages let a read skip all but a few.
PAGE_ROWS = 1024


def write_pages(df: DataFrame, path: str, order: Sequence[Column | str], number: str = "row_no") -> None:
    """Write an ordered listing once, with each row's place (from 1) in column ``number``.

    Rows lie in order, so every file, row group and data page covers a range of places and
    its statistics are the directory. Ties on ``order`` are broken by a hash of the row.
    """
    numbered = with_global_index(df, list(order), number)
    (numbered.repartitionByRange(number).sortWithinPartitions(number).write.mode("errorifexists")
     .option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path))


def read_page(spark: SparkSession, path: str, offset: int, size: int = 10, number: str = "row_no") -> DataFrame:
    """One page of a listing written by ``write_pages``; what lies before it is not read."""
    return spark.read.parquet(path).filter(F.col(number).between(offset + 1, offset + size)).orderBy(number)


def write_series(df: DataFrame, path: str, key: str, time: str, partition_by: Sequence[str] = (), files: int | None = None) -> None:
    """Write a time series for lookups by key and time range: rows are sorted by time within a
    file, whose statistics prune by time, and a Bloom filter of the keys in each row group
    prunes by key. Spark prunes by the statistics of dates and numbers, not of timestamps
    without a zone: such a column should be sorted beside a date. ``files`` fixes the number of files (default: the shuffle setting's)."""
    spread = df.repartitionByRange(*([files] if files else []), *partition_by, time).sortWithinPartitions(*partition_by, time, key)
    writer = (spread.write.mode("errorifexists").option(f"parquet.bloom.filter.enabled#{key}", "true")
              # Without a dictionary the filter is what tells that a key is not there.
              .option(f"parquet.enable.dictionary#{key}", "false").option("parquet.page.row.count.limit", PAGE_ROWS))
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
