"""Launch quality branch: enrich with dimensions, score completeness, derive
per branch, re-union, attach group statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.columns import date_parts, masked_ratio, parse_utc, whole_days_between
from rillet.functions.rules import classify, tri_state
from rillet.operators.combine import branch_columns, left_join_dims

# The fields whose presence makes a launch record complete.
REQUIRED = ["success", "rocket_name", "launchpad_name", "cost_per_launch", "details"]


def enrich(launches: DataFrame, rockets: DataFrame, pads: DataFrame) -> DataFrame:
    out = left_join_dims(launches, [(rockets, "rocket_id"), (pads, "launchpad_id")])
    ts = parse_utc("date_utc")
    parts = date_parts("launch_date")
    return out.withColumn("launch_date", ts).withColumns({
        "launch_year": parts["year"], "launch_month": parts["month"],
        "launch_day_of_week": parts["day_of_week"],
        "cost_per_payload": masked_ratio("cost_per_launch", "payloads",
                                         (F.col("payloads") > 0) & F.col("cost_per_launch").isNotNull()),
    })


def completeness(fields=REQUIRED) -> F.Column:
    """Share of required fields that are present."""
    n = None
    for f in fields:
        x = F.col(f).isNotNull().cast("int")
        n = x if n is None else n + x
    return n / F.lit(float(len(fields)))


def complexity() -> F.Column:
    c = F.col
    return classify([((c("crew") > 0) | (c("payloads") > 3), "High"), (c("payloads") > 1, "Medium")], "Low")


def reliability() -> F.Column:
    """success_rate/100 x completeness, or completeness when no rate."""
    return F.coalesce(F.col("success_rate") / 100.0 * F.col("completeness_score"), F.col("completeness_score"))


def quality_branch(df: DataFrame, as_of: str | None = None, threshold: float = 0.8) -> DataFrame:
    """Both branches in one pass: the complete rows get the full analytics,
    the others the basic metrics. Days are counted to ``as_of`` (None: the query start)."""
    scored = df.withColumn("completeness_score", completeness())
    days = whole_days_between(F.lit(as_of).cast("timestamp_ntz") if as_of else F.current_timestamp().cast("timestamp_ntz"), F.col("launch_date"))
    out = branch_columns(scored, F.col("completeness_score") >= threshold, {
        "reliability_score": (reliability(), F.col("completeness_score")),
        "mission_complexity": (complexity(), F.lit("Unknown")),
        "processing_tier": (F.lit("complete_analytics"), F.lit("basic_metrics")),
    })
    return out.withColumns({"mission_outcome": tri_state("success"), "days_since_launch": days})


def dimension_rates(launches: DataFrame, rockets: DataFrame, pads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Success rates by rocket name and by pad name. The launches are counted by both ids
    once, without any join; names are put to the counts."""
    s = F.col("success").cast("int")
    counts = launches.groupBy("rocket_id", "launchpad_id").agg(F.count("*").alias("_n"), F.count(s).alias("_known"), F.sum(s).alias("_won"))

    def rate(dim: DataFrame, key: str, name: str, out: str, total: str | None) -> DataFrame:
        named = counts.join(dim.select(key, name), key)
        g = named.groupBy(name).agg(F.try_divide(F.sum("_won"), F.sum("_known")).alias(out), F.sum("_n").alias(total or "_t"))
        return g if total else g.drop("_t")
    return (rate(rockets, "rocket_id", "rocket_name", "avg_success_rate_by_rocket", "launches_by_rocket"),
            rate(pads, "launchpad_id", "launchpad_name", "avg_success_rate_by_pad", None))


OUTPUT = ["flight_number", "name", "date_utc", "launch_year", "launch_month", "launch_day_of_week",
          "success", "details", "rocket_id", "rocket_name", "launchpad_id", "launchpad_name", "region",
          "crew", "payloads", "cores_used", "cost_per_launch", "success_rate", "cost_per_payload",
          "completeness_score", "mission_outcome", "reliability_score", "mission_complexity",
          "days_since_launch", "processing_tier", "avg_success_rate_by_rocket", "launches_by_rocket",
          "avg_success_rate_by_pad"]


def flow_quality_branch(launches: DataFrame, rockets: DataFrame, pads: DataFrame, as_of: str | None = None) -> DataFrame:
    by_rocket, by_pad = dimension_rates(launches, rockets, pads)
    rows = quality_branch(enrich(launches, rockets, pads), as_of)
    rows = rows.join(by_rocket, "rocket_name", "left").join(by_pad, "launchpad_name", "left")
    return rows.select(*OUTPUT)
