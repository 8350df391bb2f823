"""Joins, branching and set logic.

* Dimension joins stay plain ``join``s: AQE picks a broadcast at run time when
  the dimension is small and sort-merge (with skew splitting) otherwise; an
  explicit ``broadcast`` is used only for tables whose size is fixed.
* Branches are evaluated in one pass with ``when`` columns where both sides
  read the same rows; ``split``/``union`` keep the two-frame form available.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def left_join_dims(fact: DataFrame, dims: Sequence[tuple[DataFrame, str | list[str]]]) -> DataFrame:
    """Left-join a fact to each dimension on its key (unmatched keys keep NULLs)."""
    out = fact
    for dim, key in dims:
        out = out.join(dim, key, "left")
    return out


def split(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """Boolean-mask split; a NULL test goes to the false side, so no row is lost."""
    hit = F.coalesce(cond, F.lit(False))
    return df.filter(hit), df.filter(~hit)


def union_branches(*frames: DataFrame) -> DataFrame:
    """Union all by name; columns missing on one side are NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def branch_map(df: DataFrame, cond: Column, on_true: Callable[[DataFrame], DataFrame],
               on_false: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Split, derive each side, re-union (the two-scan form)."""
    t, f = split(df, cond)
    return union_branches(on_true(t), on_false(f))


def branch_columns(df: DataFrame, cond: Column, columns: Mapping[str, tuple[Column | None, Column | None]],
                   flag_name: str | None = None) -> DataFrame:
    """One-pass branch: each output column takes the true- or false-side
    expression per row (``None`` = NULL on that side)."""
    hit = F.coalesce(cond, F.lit(False))
    out = df.withColumn(flag_name, hit) if flag_name else df
    test = F.col(flag_name) if flag_name else hit
    exprs = {}
    for name, (t, f) in columns.items():
        t = F.lit(None) if t is None else t
        f = F.lit(None) if f is None else f
        exprs[name] = F.when(test, t).otherwise(f)
    return out.withColumns(exprs)


def fallback_fill(primary: DataFrame, fallback: DataFrame, key: str | list[str]) -> DataFrame:
    """Primary rows, plus fallback rows for keys the primary lacks."""
    return primary.unionByName(fallback.join(primary.select(key), key, "left_anti"),
                               allowMissingColumns=True)


def semi_dim(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Dimension rows whose key occurs in the fact (distinct keys drive the read)."""
    return dim.join(fact.select(key).distinct(), key, "left_semi")


def typed_empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame with a schema, so a later join or union still has columns."""
    return spark.createDataFrame([], schema)


def cross_summary(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cartesian product of two summaries (each is one row per label of its domain). Spark
    broadcasts a side that is small at run time; nothing is counted or computed twice."""
    return a.crossJoin(b)


def tags_contain_all(tags: Column, wanted: Sequence[str]) -> Column:
    """True when every wanted tag is in the array."""
    return F.size(F.array_except(F.array(*[F.lit(w) for w in wanted]), tags)) == 0


def tag_array(rules: Sequence[tuple[Column, str]]) -> Column:
    """Array of tags whose condition holds."""
    return F.array_compact(F.array(*[F.when(c, F.lit(t)) for c, t in rules]))
