"""Time-series indicator flow: bars -> indicators -> market context -> output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.columns import nan_to_null, pct_change, with_rounded
from rillet.functions.rules import classify
from rillet.operators.aggregate import with_group_stats
from rillet.operators.stats import exact_quantiles, with_global_stats
from rillet.operators.timeseries import with_indicators
from rillet.session import materialized

# Output columns and the columns rounded to 2 places.
OUTPUT_COLUMNS = [
    "timestamp", "date", "symbol", "open", "high", "low", "close", "volume",
    "daily_return", "ma_7", "ma_20", "volatility_7d", "rsi", "momentum",
    "volume_category", "trend", "rsi_signal", "volatility_level",
    "price_change", "price_change_pct", "day_type",
]
ROUNDED = ["open", "high", "low", "close", "daily_return", "ma_7", "ma_20",
           "volatility_7d", "rsi", "momentum", "price_change", "price_change_pct"]


def volume_category(volume: str = "volume", mean: str = "_avg_volume") -> F.Column:
    v, m = F.col(volume), F.col(mean)
    return classify([(v > m * 1.5, "high"), (v < m * 0.5, "low")], "normal")


def trend(close="close", fast="ma_7", slow="ma_20") -> F.Column:
    c, f, s = F.col(close), F.col(fast), F.col(slow)
    return classify([((c > s) & (f > s), "bullish"), ((c < s) & (f < s), "bearish")], "neutral")


def rsi_signal(rsi="rsi") -> F.Column:
    r = F.col(rsi)
    return classify([(r > 70, "overbought"), (r < 30, "oversold")], "neutral")


def volatility_level(vol="volatility_7d", q="_vol_q75") -> F.Column:
    v, t = F.col(vol), F.col(q)
    return classify([(v > t, "high"), (v < t * 0.5, "low")], "medium")


def day_type(pct="price_change_pct") -> F.Column:
    p = nan_to_null(pct)  # NaN (0/0) compares false in pandas and falls to "loss"
    return classify([(p > 2, "strong_gain"), (p > 0, "gain"), (p < -2, "strong_loss")], "loss")


def clean_bars(bars: DataFrame) -> DataFrame:
    return bars.na.drop("any").withColumn("date", F.to_date("timestamp"))


def price_context(df: DataFrame) -> DataFrame:
    """Row-wise part: open to close change and day type."""
    out = df.withColumns({"price_change": F.col("close") - F.col("open"), "price_change_pct": pct_change("close", "open")})
    return out.withColumn("day_type", day_type())


def signals(df: DataFrame) -> DataFrame:
    """Row-wise part of a frame with indicators: trend and RSI signal."""
    return df.withColumns({"trend": trend(), "rsi_signal": rsi_signal()})


def volume_context(df: DataFrame, ahead: bool = False) -> DataFrame:
    """Volume against the key's mean; ``ahead`` for a written frame (``with_group_stats``)."""
    out = with_group_stats(df, ["symbol"], {"_avg_volume": F.avg("volume")}, ahead=ahead)
    return out.withColumn("volume_category", volume_category()).drop("_avg_volume")


def volatility_context(df: DataFrame) -> DataFrame:
    """Volatility against the 75th percentile of all rows."""
    q75 = exact_quantiles(df, "volatility_7d", [0.75], ["_vol_q75"])
    return with_global_stats(df, q75).withColumn("volatility_level", volatility_level()).drop("_vol_q75")


def market_context(df: DataFrame) -> DataFrame:
    """All of the context of a written indicator frame, which is read for the quantile, the means and the rows."""
    return price_context(signals(volume_context(volatility_context(df), ahead=True)))


def rounded(df: DataFrame) -> DataFrame:
    """The output columns that are there, in order, prices and indicators to 2 places."""
    return with_rounded(df.select(*[c for c in OUTPUT_COLUMNS if c in df.columns]), [c for c in ROUNDED if c in df.columns])


def flow_indicators(bars: DataFrame, chunk_rows: int = 1 << 16) -> DataFrame:
    """Whole flow on a bars frame (symbol, timestamp, open, high, low, close, volume).

    The indicator frame feeds the rows, the per-symbol means and the global quantile; it
    is written once to the shared scratch folder instead of running the windows for each.
    """
    ind = materialized(with_indicators(clean_bars(bars), "symbol", "timestamp", chunk_rows=chunk_rows), "indicators", "zstd")
    return rounded(market_context(ind))
