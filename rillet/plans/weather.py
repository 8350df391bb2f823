"""Regional weather: fan-out reads, fan-in union, systematic sample, classify."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.columns import comfort_index
from rillet.functions.rules import bucketize, classify
from rillet.operators.ranking import systematic_sample

# Wind bins of the source (pd.cut, right-closed).
WIND_EDGES = [0, 5, 10, 20, 100]
WIND_LABELS = ["calm", "light", "moderate", "strong"]


def weather_type() -> F.Column:
    p, t = F.col("precipitation"), F.col("temperature_2m")
    return classify([(p > 5, "rainy"), (t > 25, "hot"), (t < 5, "cold")], "moderate")


def transform(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "date": F.to_date("time"), "hour": F.hour("time"),
        "weather_type": weather_type(),
        "comfort_index": comfort_index("temperature_2m", "relative_humidity_2m"),
        "wind_category": bucketize("wind_speed_10m", WIND_EDGES, WIND_LABELS),
    })


def flow_weather(merged: DataFrame, sample_rows: int | None = None) -> DataFrame:
    """Classify the regions' rows; with ``sample_rows`` only every k-th row of them in
    (region, time, id) order, so many in all."""
    if sample_rows:
        merged = systematic_sample(merged, [F.col("region"), F.col("time"), F.col("event_id")], sample_rows).drop("_rn")
    return transform(merged)
