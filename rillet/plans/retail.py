"""Two-source retail / games job: clean each side, summarise each, cross them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.columns import (date_parts, decade, parse_timestamp, row_argmax, row_sum,
                                      snake_case_names, strip_suffix, when_columns_exist,
                                      with_coerced_numbers)
from rillet.functions.rules import bucketize
from rillet.operators.aggregate import group_agg, group_agg_domain
from rillet.operators.combine import cross_summary

# Bin edges and labels of the source (pd.cut, right-closed).
AGE_EDGES = [0, 18, 30, 45, 60, 100]
AGE_LABELS = ["Under 18", "18-30", "31-45", "46-60", "Over 60"]
SPEND_EDGES = [0, 50, 200, 500, float("inf")]
SPEND_LABELS = ["Low", "Medium", "High", "Premium"]
SALES_EDGES = [0, 0.5, 2, 5, float("inf")]
SALES_LABELS = ["Niche", "Moderate", "Popular", "Blockbuster"]
DATE_FORMAT = "M/d/yyyy"


def clean_shopping(df: DataFrame, date_format: str = DATE_FORMAT) -> DataFrame:
    out = snake_case_names(df)

    def dates(d):
        d = d.withColumn("invoice_date", parse_timestamp("invoice_date", date_format))
        p = date_parts("invoice_date")
        return d.withColumns({"year": p["year"], "month": p["month"], "day_of_week": p["day_of_week"]})

    out = when_columns_exist(out, ["invoice_date"], dates)
    out = when_columns_exist(out, ["price", "quantity"],
                             lambda d: d.withColumn("total_amount", F.col("price") * F.col("quantity")))
    out = when_columns_exist(out, ["age"], lambda d: d.withColumn(
        "age_group", bucketize("age", AGE_EDGES, AGE_LABELS)))
    return when_columns_exist(out, ["total_amount"], lambda d: d.withColumn(
        "spending_tier", bucketize("total_amount", SPEND_EDGES, SPEND_LABELS)))


def clean_games(df: DataFrame, regional: list[str] | None = None) -> DataFrame:
    """Regional columns are given explicitly (default: the source columns whose
    name contains ``sales``, taken before any derived column exists)."""
    out = snake_case_names(df)
    regional = regional or [c for c in out.columns if "sales" in c and c != "global_sales"]
    sales = regional + (["global_sales"] if "global_sales" in out.columns else [])
    out = with_coerced_numbers(out, sales)
    if len(sales) > 1 and "global_sales" not in out.columns:
        out = out.withColumn("global_sales", row_sum(regional))
    out = when_columns_exist(out, ["global_sales"], lambda d: d.withColumn(
        "sales_category", bucketize("global_sales", SALES_EDGES, SALES_LABELS)))
    out = when_columns_exist(out, ["year"], lambda d: with_coerced_numbers(d, ["year"]).withColumn(
        "decade", decade("year")))
    if regional:
        out = out.withColumn("primary_market", row_argmax(regional, strip_suffix(regional, "_sales")))
    return out


def shopping_summary(shop: DataFrame) -> DataFrame:
    return group_agg_domain(shop, "age_group", AGE_LABELS,
                            sums={"total_revenue": F.sum("total_amount")},
                            counts={"transaction_count": F.count("total_amount")},
                            means={"avg_transaction": F.avg("total_amount")})


def games_summary(games: DataFrame) -> DataFrame:
    return group_agg(games, ["decade"], {"total_sales_millions": F.sum("global_sales"),
                                         "avg_sales": F.avg("global_sales"),
                                         "game_count": F.count("global_sales")})


def flow_retail_cross(shopping: DataFrame, titles: DataFrame) -> DataFrame:
    s = shopping_summary(clean_shopping(shopping))
    g = games_summary(clean_games(titles))
    return cross_summary(s, g).select(
        "age_group", "decade", F.col("total_revenue").alias("shopping_revenue"),
        F.col("transaction_count").alias("shopping_transactions"),
        F.col("avg_transaction").alias("avg_shopping_amount"),
        F.col("total_sales_millions").alias("gaming_sales_millions"),
        F.col("game_count").alias("games_released"), F.col("avg_sales").alias("avg_game_sales"))
