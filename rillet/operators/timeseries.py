"""Per-key ordered time-series indicators (row-based rolling frames).

``rolling`` evaluates window columns over ``partitionBy(key).orderBy(order)`` with bounded
row frames. A hot key is not one task: its rows are cut into ranges of the order column by
quantiles of that column, and rows are shuffled once, by key and range. Every range is
evaluated for itself; its first ``lookback`` rows, which lack the rows before them, are
evaluated once more among the edges of the key's ranges (a halo exchange: only the first
and the last rows of each range move, whole ranges where these are shorter). Results are
exact, and building the frame runs no job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillet.functions.columns import float_div

# A stage maps (window spec) -> {column name: expression}; stages run in order,
# so a later stage may use the columns of an earlier one.
Stage = Callable[[WindowSpec], dict[str, Column]]

#: Ranges of all keys together are at most about so many, whatever the input, and so many of one key.
MOST_RANGES, MOST_OF_KEY = 1 << 16, 1 << 10


def _place(df: DataFrame, column: str) -> Column:
    """The order column as a number."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    raise TypeError(f"rows are cut into ranges of a number or a time, not of {column}: {kind.simpleString()}")


def _at_most(bounds: Column, x: Column) -> Column:
    """How many of the sorted ``bounds`` are at most x, by bisection."""
    def step(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        above = F.coalesce(F.get(bounds, middle) <= x, F.lit(False))
        going = s["lo"] < s["hi"]
        return F.struct(F.when(going & above, middle + 1).otherwise(s["lo"]).alias("lo"), F.when(going & ~above, middle).otherwise(s["hi"]).alias("hi"))
    steps = F.sequence(F.lit(1), F.lit(MOST_OF_KEY.bit_length()))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi")), step, lambda s: s["lo"])


def with_ranges(df: DataFrame, key: str, order: str, rows: int, name: str = "_range") -> DataFrame:
    """Add the number of the row's range of ``order`` within its key, 0 for keys of at most ``rows`` rows,
    and whether the key was cut (``_cut``).

    A larger key is cut at quantiles of its order column into ranges of about ``rows`` rows
    (of a ``MOST_RANGES``-th of all rows if that is more). So the bounds that go to every task
    are at most ``MOST_RANGES`` numbers. Rows of one key and order value share a range.
    """
    counts = df.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    each = F.greatest(F.lit(rows), F.ceil(counts.agg(F.sum("_n")).scalar() / MOST_RANGES))
    hot = counts.withColumn("_parts", F.least(F.ceil(F.col("_n") / each), F.lit(MOST_OF_KEY)).cast("int")).filter("_parts > 1")
    # At most MOST_RANGES keys have more rows than a MOST_RANGES-th of all.
    mine = df.select(F.col(f"`{key}`").alias("_k"), _place(df, order).alias("_x")).join(F.broadcast(hot), F.col("_k").eqNullSafe(F.col("_key")))
    shares = ", ".join(f"{k / MOST_OF_KEY}D" for k in range(1, MOST_OF_KEY))
    cuts = mine.groupBy("_key").agg(F.expr(f"percentile_approx(_x, array({shares}))").alias("_q"), F.first("_parts").alias("_parts"))
    # Every so many-th quantile, so that a key gets its number of ranges.
    wanted = F.transform(F.sequence(F.lit(1), F.col("_parts") - 1), lambda k: F.get("_q", F.floor(k * MOST_OF_KEY / F.col("_parts")).cast("int") - 1))
    bounds = F.broadcast(cuts.select("_key", F.array_distinct(wanted).alias("_bounds")))
    joined = df.join(bounds, F.col(f"`{key}`").eqNullSafe(F.col("_key")), "left").withColumn("_cut", F.col("_bounds").isNotNull())
    return joined.withColumn(name, F.when(F.col("_cut"), _at_most(F.col("_bounds"), _place(df, order))).otherwise(0)).drop("_key", "_bounds")


def rolling(df: DataFrame, key: str, order: Sequence[str], stages: Sequence[Stage],
            lookback: int, chunk_rows: int = 1 << 16) -> DataFrame:
    """Apply window ``stages`` per key in time order.

    ``lookback`` must cover the deepest chain of row references of all stages
    (e.g. 19 for a 20-row mean; 14 for RSI-14 on first differences). ``chunk_rows`` is the
    number of rows from which a key is cut into ranges of its first order column.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    # Rows tied on the order key get a fixed order (a hash of the whole row), so results are repeatable.
    base = with_ranges(df.withColumn("_tie", F.xxhash64(*columns)), key, order[0], chunk_rows)
    within = Window.partitionBy(key, "_range").orderBy(*order, "_tie")
    along = Window.partitionBy(key).orderBy(*order, "_tie")

    def staged(rows: DataFrame, w: WindowSpec) -> DataFrame:
        for st in stages:
            rows = rows.withColumns(st(w))
        return rows
    # Rows of a range that have all the rows before them that they need.
    placed = base.withColumn("_at", F.row_number().over(within))
    # ``_cut`` decides nothing here; naming it gives both branches the same columns, so they read one exchange.
    inner = staged(placed, within).filter(~F.col("_cut") | (F.col("_range") == 0) | (F.col("_at") > lookback))
    edges = placed.withColumn("_end", F.lead(F.lit(True), max(lookback, 1)).over(within).isNull())
    edges = edges.filter((F.col("_at") <= lookback) & (F.col("_range") > 0) | F.col("_end") & F.col("_cut"))
    outer = staged(edges.drop("_end"), along).filter((F.col("_range") > 0) & (F.col("_at") <= lookback))
    return inner.unionByName(outer).drop("_tie", "_range", "_at", "_cut")


# ---------------------------------------------------------------- indicators

def returns_and_averages(close: str = "close", fast: int = 7, slow: int = 20) -> Stage:
    """Daily return % vs the previous row, and fast/slow moving averages
    (``rolling(n, min_periods=1).mean()``)."""
    def st(w: WindowSpec) -> dict[str, Column]:
        prev = F.lag(close, 1).over(w)
        return {
            "daily_return": (float_div(F.col(close), prev) - F.lit(1.0)) * F.lit(100.0),
            f"ma_{fast}": F.avg(close).over(w.rowsBetween(1 - fast, 0)),
            f"ma_{slow}": F.avg(close).over(w.rowsBetween(1 - slow, 0)),
            "_delta": F.col(close) - prev,
        }
    return st


def volatility_and_rsi(window: int = 7, rsi_n: int = 14) -> Stage:
    """Rolling sample std of returns and the simple-average RSI.

    RSI: mean gain / mean loss over ``rsi_n`` rows of first differences, the
    first row counting as 0 gain and 0 loss; a zero mean loss becomes 0.0001.
    """
    def st(w: WindowSpec) -> dict[str, Column]:
        d = F.col("_delta")
        return {
            f"volatility_{window}d": F.stddev_samp("daily_return").over(w.rowsBetween(1 - window, 0)),
            "_gain": F.avg(F.when(d > 0, d).otherwise(F.lit(0.0))).over(w.rowsBetween(1 - rsi_n, 0)),
            "_loss": F.avg(F.when(d < 0, -d).otherwise(F.lit(0.0))).over(w.rowsBetween(1 - rsi_n, 0)),
        }
    return st


def rsi_from_means(gain: str = "_gain", loss: str = "_loss") -> Column:
    """``100 - 100 / (1 + gain/loss)`` with a zero mean loss taken as 0.0001."""
    lo = F.col(loss)
    lo = F.when(lo == 0, F.lit(0.0001)).otherwise(lo)
    return F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.col(gain) / lo)


def momentum(close: str = "close", ma: str = "ma_7") -> Column:
    """Distance of close from its moving average, in percent."""
    return float_div(F.col(close) - F.col(ma), F.col(ma)) * F.lit(100.0)


INDICATOR_COLUMNS = ["daily_return", "ma_7", "ma_20", "volatility_7d", "rsi", "momentum"]


def with_indicators(bars: DataFrame, key: str = "symbol", ts: str = "timestamp",
                    chunk_rows: int = 1 << 16) -> DataFrame:
    """Return, MA(7), MA(20), 7-row volatility, RSI(14) and momentum per key;
    missing values (first rows) become 0."""
    out = rolling(bars, key, [ts], [returns_and_averages(), volatility_and_rsi()],
                  lookback=19, chunk_rows=chunk_rows)
    out = out.withColumns({"momentum": momentum(), "rsi": rsi_from_means()}).drop("_delta", "_gain", "_loss")
    return out.fillna(0.0, subset=INDICATOR_COLUMNS)
