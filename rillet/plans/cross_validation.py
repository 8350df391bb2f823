"""Cross-timeframe validation: spot snapshot vs a fine and a coarse series.

Each grain is aggregated once (mean, sample std, volume mean, max, min in one
pass) and joined back to the spot rows on the key; scores and labels are
native CASE expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.columns import coef_variation, deviation_pct, range_position, with_rounded
from rillet.functions.rules import classify, flag, score
from rillet.operators.aggregate import lookup_with_default

# Columns rounded to 2 places in the output.
ROUNDED = ["spot_price", "avg_24h_price", "avg_7d_price", "price_deviation_24h_pct",
           "price_deviation_7d_pct", "volume_deviation_pct", "volatility_score", "confidence_score",
           "manipulation_score", "price_24h_high", "price_24h_low", "price_7d_high", "price_7d_low",
           "position_in_24h_range_pct", "position_in_7d_range_pct"]


def cross_validate(spot: DataFrame, fine: DataFrame, coarse: DataFrame) -> DataFrame:
    """Per spot row: grain means (spot price / 0 when a grain has no rows),
    deviations, volume anomaly, coefficient of variation and trend agreement.
    The grain ranges (max/min) come from the same aggregates."""
    c = F.col
    out = lookup_with_default(
        spot.withColumnRenamed("spot_price_usd", "spot_price").withColumn("spot_price_usd", c("spot_price")),
        fine, ["crypto_id"],
        {"avg_24h_price": F.avg("price_usd"), "std_24h_price": F.stddev_samp("price_usd"),
         "avg_24h_volume": F.avg("volume"), "price_24h_high": F.max("price_usd"),
         "price_24h_low": F.min("price_usd")},
        {"avg_24h_price": c("spot_price"), "std_24h_price": F.lit(0.0), "avg_24h_volume": F.lit(0.0)})
    out = lookup_with_default(
        out, coarse, ["crypto_id"],
        {"avg_7d_price": F.avg("price_usd"), "avg_7d_volume": F.avg("volume"),
         "price_7d_high": F.max("price_usd"), "price_7d_low": F.min("price_usd")},
        {"avg_7d_price": c("spot_price"), "avg_7d_volume": F.lit(0.0)})
    out = out.withColumns({
        "price_deviation_24h_pct": deviation_pct("spot_price", "avg_24h_price"),
        "price_deviation_7d_pct": deviation_pct("spot_price", "avg_7d_price"),
        "volume_deviation_pct": deviation_pct("volume_24h", "avg_7d_volume"),
        "volatility_score": coef_variation("std_24h_price", "avg_24h_price"),
    })
    out = out.withColumns({
        "trend_24h": F.when(c("price_deviation_24h_pct") > 0, "up").otherwise("down"),
        "trend_7d": F.when(c("price_deviation_7d_pct") > 0, "up").otherwise("down"),
    })
    return out.withColumn("trend_consistent", c("trend_24h") == c("trend_7d"))


def confidence_score(dev24="price_deviation_24h_pct", dev7="price_deviation_7d_pct",
                     vol="volatility_score", consistent="trend_consistent",
                     voldev="volume_deviation_pct") -> F.Column:
    a24, a7 = F.abs(F.col(dev24)), F.abs(F.col(dev7))
    v = F.col(vol)
    return score([
        (a24 > 10, -20), ((a24 <= 10) & (a24 > 5), -10),
        (a7 > 15, -15), ((a7 <= 15) & (a7 > 10), -10),
        (v > 5, -15), ((v <= 5) & (v > 3), -10),
        (~flag(F.col(consistent)), -15),
        (F.abs(F.col(voldev)) > 50, -10),
    ], base=100.0, lo=0.0, hi=100.0)


def data_quality(conf="confidence_score") -> F.Column:
    x = F.col(conf)
    return classify([(x >= 80, "high"), (x >= 60, "medium"), (x >= 40, "low")], "very_low")


def reliability_rating(conf="confidence_score") -> F.Column:
    x = F.col(conf)
    return classify([(x >= 90, "A"), (x >= 75, "B"), (x >= 60, "C"), (x >= 50, "D")], "F")


def feedback_enrich(cv: DataFrame) -> DataFrame:
    out = cv.withColumn("confidence_score", confidence_score())
    return out.withColumns({"data_quality": data_quality(), "reliability_rating": reliability_rating()})


def manipulation_score() -> F.Column:
    c = F.col
    return score([
        (F.abs(c("price_deviation_24h_pct")) > 10, 30),
        (F.abs(c("volume_deviation_pct")) > 50, 25),
        (c("volatility_score") > 5, 20),
        (~flag(c("trend_consistent")), 15),
        (c("confidence_score") < 50, 10),
    ], hi=100.0)


def classify_anomalies(df: DataFrame) -> DataFrame:
    c = F.col
    d24 = c("price_deviation_24h_pct")
    out = df.withColumns({
        "flash_crash_risk": classify([(d24 < -10, "high"), (d24 < -5, "medium")], "low"),
        "pump_risk": classify([(d24 > 15, "high"), (d24 > 10, "medium")], "low"),
        "volume_manipulation_flag": flag(F.abs(c("volume_deviation_pct")) > 100),
        "manipulation_score": manipulation_score(),
    })
    m = c("manipulation_score")
    return out.withColumns({
        "risk_level": classify([(m >= 75, "critical"), (m >= 50, "high"), (m >= 25, "medium")], "low"),
        "requires_investigation": flag(m >= 50),
        "market_sentiment": classify([
            (flag(c("trend_consistent")) & (c("trend_24h") == "up"), "bullish"),
            (flag(c("trend_consistent")) & (c("trend_24h") == "down"), "bearish")], "neutral"),
    })


def merge_final(df: DataFrame, meta: DataFrame) -> DataFrame:
    out = df.join(meta, ["crypto_id", "symbol"], "left")
    out = out.withColumns({
        "position_in_24h_range_pct": range_position("spot_price", "price_24h_low", "price_24h_high"),
        "position_in_7d_range_pct": range_position("spot_price", "price_7d_low", "price_7d_high"),
    })
    return with_rounded(out, ROUNDED)


def flow_cross_validation(spot: DataFrame, fine: DataFrame, coarse: DataFrame,
                          meta: DataFrame) -> DataFrame:
    cv = cross_validate(spot, fine, coarse)
    return merge_final(classify_anomalies(feedback_enrich(cv)), meta).drop("std_24h_price")
