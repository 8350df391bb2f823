"""Row numbering, per-key picks, sampling, ordering and paging.

Global numbering never uses an unpartitioned ``Window`` (one task for all
rows). ``with_global_index`` range-partitions on the order key, numbers rows
inside each partition and adds per-partition offsets from a tiny count table,
so every step is distributed and a hot key is split over many partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.session import materialized

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: record number within a partition


def _partitions(df: DataFrame, n: int | None) -> int:
    """Range partitions for a numbering: those asked for, else the session's shuffle partitions (which
    ``cluster_conf`` sizes by the input; AQE does not coalesce a range count), at least the default parallelism."""
    spark = df.sparkSession
    return n or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_global_index(df: DataFrame, order: Sequence[Column | str], name: str = "_rn",
                      n_parts: int | None = None, tie_break: bool = True) -> DataFrame:
    """Add a 1-based row number over ``order`` (which should be a total order).

    Steps: range-partition on ``order`` with a fixed partition count (AQE does not
    coalesce it), sort inside partitions, take each row's ordinal from
    ``monotonically_increasing_id``, write that to the shared scratch folder, count rows
    per partition (one row per partition, a proven size bound, so it is broadcast) and add
    the prefix sum. Counts and rows read the same written ordinals, whatever executor is
    lost meanwhile, and nothing stays cached.
    """
    n = _partitions(df, n_parts)
    if tie_break:
        # Rows tied on ``order`` are ordered by a hash of the whole row: the
        # numbering is repeatable and a heavily repeated key still spreads over
        # many range partitions.
        df = df.withColumn("_tb", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        order = list(order) + [F.col("_tb")]
    mid = F.monotonically_increasing_id()
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_mid", mid)
              .withColumns({"_pid": F.shiftright(F.col("_mid"), 33), "_ord": F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))})
              .drop("_mid", "_tb"))
    tagged = materialized(ranged, "numbered", "zstd")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.col("_ord") + F.lit(1))
            .drop("_pid", "_ord", "_off"))


#: Parts of a key in the first of two top-n levels.
_SALTS = 32


def first_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int,
                    name: str | None = None) -> DataFrame:
    """``head(n)`` per key in two levels: the first n of every part of a key, then the first
    n of the survivors, so one task meets at most ``32 * n`` rows of a hot key."""
    col = name or "_rank"
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(_SALTS))
    parts = Window.partitionBy(*keys, "_part").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_part", part).withColumn("_first", F.row_number().over(parts)).filter(F.col("_first") <= n)
    out = out.drop("_first", "_part").withColumn(col, F.row_number().over(whole)).filter(F.col(col) <= n)
    return out if name else out.drop(col)


def last_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                   name: str | None = None) -> DataFrame:
    """``tail(n)`` per key: the n rows with the largest order key."""
    desc = [o.desc() if isinstance(o, Column) else F.col(o).desc() for o in order]
    return first_n_per_key(df, keys, desc, n, name)


def systematic_sample(df: DataFrame, order: Sequence[Column | str], m: int) -> DataFrame:
    """Every k-th row of the ordered set, ``k = n // m``, the first m of them;
    all rows when ``n <= m``. Sampling is the feature here, so it keeps m rows."""
    idx = with_global_index(df, order, "_rn")
    n = idx.count()  # one number, from the written ordinals
    if n <= m:
        return idx
    step = n // m
    return idx.filter((F.pmod(F.col("_rn") - 1, F.lit(step)) == 0) & (F.col("_rn") <= F.lit(step * m)))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Most-recent / largest k rows: ``orderBy().limit()`` plans as TakeOrdered
    (per-partition top-k, then a k-row merge)."""
    return df.orderBy(*order).limit(k)


def page(df: DataFrame, order: Sequence[Column | str], offset: int, size: int = 10) -> DataFrame:
    """One page of an ordered listing."""
    return df.orderBy(*order).offset(offset).limit(size)


def ordinal_key(c: Column | str, labels: Sequence[str]) -> Column:
    """Rank of a label in a fixed order (unknown labels last)."""
    m = F.create_map(*[x for i, lab in enumerate(labels) for x in (F.lit(lab), F.lit(i))])
    return F.coalesce(F.element_at(m, c if isinstance(c, Column) else F.col(c)), F.lit(len(labels)))
