"""Grouped aggregates, value distributions and profiles.

Group statistics that must appear on every row (``transform('mean')``) are a
``groupBy`` (partially aggregated before the shuffle, so a hot key is combined
map-side) joined back on the key; AQE turns the join into a broadcast when the
per-key table turns out small and splits a skewed key otherwise. A per-key
``Window`` would put all rows of a hot key into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillet.session import materialized


#: Keys whose statistics, written ahead, go to every task; rows are shuffled to those of more keys.
BROADCAST_KEYS = 1 << 20


def with_group_stats(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column], ahead: bool = False) -> DataFrame:
    """Attach per-key aggregates to every row (rows with a NULL key get NULL).

    ``ahead`` writes the statistics before the rows are joined, for a frame that is cheap to
    read twice (a written one): with the number of keys known, rows move only if there are
    more than ``BROADCAST_KEYS``. Else one plan does both, and rows are shuffled along with
    the statistics, since their size shows too late.
    """
    per_key = df.filter(_all_not_null(keys)).groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    if ahead:
        per_key = materialized(per_key, "group-stats")
        per_key = F.broadcast(per_key) if per_key.count() <= BROADCAST_KEYS else per_key
    return df.join(per_key, list(keys), "left")


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def group_agg(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """``groupby(keys).agg(...)`` with flat names; NULL keys are dropped (pandas)."""
    return df.filter(_all_not_null(keys)).groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def group_agg_domain(df: DataFrame, key: str, domain: Sequence[str], sums: Mapping[str, Column],
                     counts: Mapping[str, Column], means: Mapping[str, Column],
                     order_name: str | None = None) -> DataFrame:
    """Group-by over a categorical's full label domain: unobserved labels give
    sum 0, count 0, mean NULL (pandas ``observed=False``); NULL keys dropped.

    The label domain is a literal list (a few labels), joined with the
    aggregate as the small side.
    """
    spark: SparkSession = df.sparkSession
    dom = spark.createDataFrame([(i, lab) for i, lab in enumerate(domain)],
                                T.StructType([T.StructField(order_name or "_label_order", T.IntegerType()),
                                              T.StructField(key, T.StringType())]))
    aggs = {**sums, **counts, **means}
    per = group_agg(df, [key], aggs)
    out = F.broadcast(dom).join(per, key, "left")
    fills = {n: F.coalesce(F.col(n), F.lit(0).cast(per.schema[n].dataType)) for n in list(sums) + list(counts)}
    out = out.withColumns(fills)
    return out if order_name else out.drop("_label_order")


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Distribution of a column; NULL dropped; ordered by count desc, then label
    (the sort runs on the aggregated rows, one per distinct value)."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.col(name).desc(), F.col(col))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows and non-null count per column, as one long frame (column, rows, non_null)."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"_nn_{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', `_nn_{i}`" for i, c in enumerate(cols))
    return one.selectExpr("_rows AS rows", f"stack({len(cols)}, {stack}) AS (column_name, non_null)")


def parent_profile(children: DataFrame, parent: str, child_type: str, special_type: str,
                   child_id: str) -> DataFrame:
    """Per parent: any child of a given type, child count, distinct child types."""
    return children.groupBy(parent).agg(
        F.coalesce(F.bool_or(F.col(child_type) == special_type), F.lit(False)).alias("has_special"),
        F.count(F.col(child_id)).alias("n_children"),
        F.count_distinct(F.col(child_type)).alias("n_types"))


def lookup_with_default(left: DataFrame, series: DataFrame, key: Sequence[str],
                        aggs: Mapping[str, Column], defaults: Mapping[str, Column]) -> DataFrame:
    """Per-key aggregates of ``series`` joined to ``left``; keys without rows
    get ``defaults`` (a statistic of one row, e.g. a sample std, stays NULL)."""
    per = series.groupBy(*key).agg(*[c.alias(n) for n, c in aggs.items()], F.max(F.lit(True)).alias("_seen"))
    out = left.join(per, list(key), "left")
    out = out.withColumns({n: F.when(F.col("_seen").isNull(), defaults[n]).otherwise(F.col(n))
                           for n in aggs if n in defaults})
    return out.drop("_seen")
