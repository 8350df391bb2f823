"""Registered queries over the driver tables (one per inventory item).

Each builder reads whole tables through ``rillet.plans.fixtures`` and returns
a lazy DataFrame; the oracle SQL next to it is the DuckDB equivalent.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillet import sinks
from rillet.functions import columns as fc
from rillet.operators import aggregate as agg
from rillet.operators import combine as cmb
from rillet.operators import lookup
from rillet.operators import ranking
from rillet.plans import creatures as crf
from rillet.plans import cross_validation as cvf
from rillet.plans import fixtures as fx
from rillet.plans import indicators as inf
from rillet.plans import launches as lf
from rillet.plans import oracle as sql
from rillet.plans import pages as pgf
from rillet.plans import parents as prf
from rillet.plans import retail as rt
from rillet.plans import threat as thr
from rillet.plans import weather as wf
from rillet.plans.catalog import register
from rillet.operators.timeseries import with_indicators
from rillet.plans.indicators import flow_indicators
from rillet.session import checkpoint_dir, materialized
from rillet.sources import files as fs
from rillet.sources import html as htm
from rillet.sources import json_array as ja
from rillet.sources import reshape as rs


@register("flow_indicators", sql.flow_indicators)
def q_flow_indicators(spark: SparkSession, sf: str) -> DataFrame:
    return flow_indicators(fx.bars(spark, sf))


# ---------------------------------------------------------------- market flow


def _market(spark, sf):
    return cvf.flow_cross_validation(fx.spot(spark, sf), fx.hourly(spark, sf), fx.daily(spark, sf),
                                     fx.metadata(spark, sf))


@register("flow_cross_validation", sql.flow_cross_validation)
def q_flow_cross_validation(spark, sf):
    return _market(spark, sf).select(*sql.MARKET_FINAL_COLS)


def _market_view(name, cols):
    @register(name, lambda: sql.flow_cross_validation(cols))
    def q(spark, sf):
        return _market(spark, sf).select(*cols)
    q.__name__ = f"q_{name}"
    return q


# Each view is one operator of the flow, checked on its own columns.
_market_view("confidence_score", ["crypto_id", "price_deviation_24h_pct", "price_deviation_7d_pct",
                                  "volatility_score", "trend_consistent", "volume_deviation_pct",
                                  "confidence_score"])
_market_view("quality_rating", ["crypto_id", "confidence_score", "data_quality", "reliability_rating"])
_market_view("crash_pump_risk", ["crypto_id", "price_deviation_24h_pct", "flash_crash_risk", "pump_risk"])
_market_view("manipulation_score", ["crypto_id", "manipulation_score", "volume_manipulation_flag",
                                    "risk_level", "requires_investigation"])
_market_view("sentiment", ["crypto_id", "trend_24h", "trend_7d", "trend_consistent", "market_sentiment"])
_market_view("range_position", ["crypto_id", "spot_price", "price_24h_low", "price_24h_high",
                                "price_7d_low", "price_7d_high", "position_in_24h_range_pct",
                                "position_in_7d_range_pct"])
_market_view("cross_validate", ["crypto_id", "symbol", "spot_price", "avg_24h_price", "avg_7d_price",
                                "price_deviation_24h_pct", "price_deviation_7d_pct", "volume_deviation_pct",
                                "volatility_score", "trend_24h", "trend_7d", "trend_consistent",
                                "avg_24h_volume", "avg_7d_volume"])
_market_view("left_join_composite", ["crypto_id", "symbol", "name", "market_cap_rank", "risk_level"])
_market_view("deviation_pct", ["crypto_id", "spot_price", "avg_24h_price", "price_deviation_24h_pct"])
_market_view("coef_variation", ["crypto_id", "avg_24h_price", "volatility_score"])
_market_view("lookup_default", ["crypto_id", "spot_price", "avg_24h_price", "avg_24h_volume",
                                "avg_7d_price", "avg_7d_volume"])
_market_view("range_enrich", ["crypto_id", "price_24h_high", "price_24h_low", "price_7d_high", "price_7d_low"])


# ---------------------------------------------------------------- indicator views


def _ind_view(name, cols, part):
    """A column set of the flow, from the part of the flow that makes it."""
    @register(name, lambda: sql.flow_indicators(cols))
    def q(spark, sf):
        return inf.rounded(part(inf.clean_bars(fx.bars(spark, sf)))).select(*cols)
    q.__name__ = f"q_{name}"
    return q


def _with_volatility(bars):
    return inf.volatility_context(materialized(with_indicators(bars), "indicators", "zstd"))


_ind_view("daily_return", ["symbol", "timestamp", "close", "daily_return"], with_indicators)
_ind_view("moving_average", ["symbol", "timestamp", "close", "ma_7", "ma_20"], with_indicators)
_ind_view("rolling_volatility", ["symbol", "timestamp", "daily_return", "volatility_7d"], with_indicators)
_ind_view("rsi", ["symbol", "timestamp", "close", "rsi"], with_indicators)
_ind_view("momentum", ["symbol", "timestamp", "close", "ma_7", "momentum"], with_indicators)
_ind_view("volume_category", ["symbol", "timestamp", "volume", "volume_category"], inf.volume_context)
_ind_view("trend", ["symbol", "timestamp", "close", "ma_7", "ma_20", "trend"], lambda b: inf.signals(with_indicators(b)))
_ind_view("rsi_signal", ["symbol", "timestamp", "rsi", "rsi_signal"], lambda b: inf.signals(with_indicators(b)))
_ind_view("volatility_level", ["symbol", "timestamp", "volatility_7d", "volatility_level"], _with_volatility)
_ind_view("day_type", ["symbol", "timestamp", "price_change_pct", "day_type"], inf.price_context)
_ind_view("pct_change_row", ["symbol", "timestamp", "open", "close", "price_change", "price_change_pct"], inf.price_context)
_ind_view("round_cols", ["symbol", "timestamp", "open", "high", "low", "close"], lambda b: b)
_ind_view("select_reorder", ["timestamp", "date", "symbol", "open", "high", "low", "close", "volume"], lambda b: b)


@register("tail_per_key", sql.tail_per_key)
def q_tail_per_key(spark, sf):
    b = fx.bars(spark, sf)
    return ranking.last_n_per_key(b, ["symbol"], [F.col("timestamp")], 66).select("symbol", "timestamp", "close")


@register("head_per_key", sql.head_per_key)
def q_head_per_key(spark, sf):
    h = fx.hourly(spark, sf)
    return ranking.first_n_per_key(h, ["crypto_id"], ["timestamp", "price_usd", "volume"], 24).select(
        "crypto_id", "timestamp", "price_usd", "volume")


@register("sort_multi", lambda: sql.with_ctes({"bars": sql.BARS},
          'SELECT symbol, "timestamp", close FROM bars ORDER BY symbol, "timestamp"'))
def q_sort_multi(spark, sf):
    return fx.bars(spark, sf).select("symbol", "timestamp", "close").orderBy("symbol", "timestamp")


# ---------------------------------------------------------------- network threat


@register("flow_threat", sql.threat)
def q_flow_threat(spark, sf):
    return thr.flow_threat(fx.packets(spark, sf))


def _threat_view(name, cols, part):
    """A column set of the flow, from the part of the flow that makes it."""
    @register(name, lambda: sql.threat(cols))
    def q(spark, sf):
        return part(fx.packets(spark, sf)).select(*[f"`{c}`" for c in cols])
    q.__name__ = f"q_{name}"
    return q


def _scored(packets):
    return thr.risk_points(thr.analyze(packets))


_threat_view("packet_category", ["flow_id", "packet_size", "packet_category"], thr.describe)
_threat_view("threat_level", ["flow_id", "risk_score", "threat_level", "requires_investigation"], _scored)
_threat_view("onehot_decode", ["flow_id", "protocol_type_tcp", "protocol_type_udp", "protocol_type_icmp",
                               "primary_protocol"], thr.describe)
_threat_view("risk_score", ["flow_id", "labeled_threat", "uses_suspicious_port", "high_volume_traffic",
                            "low_entropy_traffic", "potential_syn_flood", "packet_size", "risk_score"], _scored)
_threat_view("max_normalize", ["flow_id", "risk_score", "anomaly_confidence"], thr.flow_threat)
_threat_view("isin_flag", ["flow_id", "src_port", "dst_port", "uses_suspicious_port"], thr.describe)
_threat_view("quantile_flag", ["flow_id", "packet_count_5s", "high_volume_traffic", "spectral_entropy",
                               "low_entropy_traffic"], thr.volume_flags)
_threat_view("pattern_flag", ["flow_id", "tcp_flags_SYN", "tcp_flags_SYN-ACK", "potential_syn_flood"], thr.describe)


@register("quantiles", lambda: sql.with_ctes({"packets": sql.PACKETS}, "SELECT " + ", ".join(
    f"{sql.r(f'quantile_cont(packet_count_5s, {q})', 6)} AS q{int(q * 100)}" for q in (0.15, 0.25, 0.75, 0.85))
    + " FROM packets"))
def q_quantiles(spark, sf):
    from rillet.operators.stats import exact_quantiles
    out = exact_quantiles(fx.packets(spark, sf), "packet_count_5s", [0.15, 0.25, 0.75, 0.85],
                          ["q15", "q25", "q75", "q85"])
    return out.select(*[fc.round_half_even(c, 6).alias(c) for c in out.columns])


@register("protocol_class", lambda: sql.with_ctes({"packets": sql.PACKETS}, """
SELECT flow_id, protocol, CASE WHEN upper(protocol) IN ('TCP', '6') THEN 'tcp' WHEN upper(protocol) IN ('UDP', '17') THEN 'udp'
  WHEN upper(protocol) IN ('ICMP', '1') THEN 'icmp' WHEN upper(protocol) IN ('HTTP', 'HTTPS') THEN 'http'
  ELSE 'other' END AS protocol_family FROM packets"""))
def q_protocol_class(spark, sf):
    return fx.packets(spark, sf).select("flow_id", "protocol", fc.protocol_family("protocol").alias("protocol_family"))


@register("ip_private", lambda: sql.with_ctes({"packets": sql.PACKETS}, """
SELECT flow_id, src_ip, coalesce(len(parts) = 4 AND a IS NOT NULL AND b IS NOT NULL
  AND (a = 10 OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 168)), false) AS is_private
FROM (SELECT flow_id, src_ip, string_split(src_ip, '.') AS parts,
             TRY_CAST(string_split(src_ip, '.')[1] AS INTEGER) AS a,
             TRY_CAST(string_split(src_ip, '.')[2] AS INTEGER) AS b FROM packets) t"""))
def q_ip_private(spark, sf):
    return fx.packets(spark, sf).select("flow_id", "src_ip", fc.is_private_ipv4("src_ip").alias("is_private"))


# ---------------------------------------------------------------- launches


def _launch_flow(spark, sf):
    out = lf.flow_quality_branch(fx.launches(spark, sf), fx.rockets(spark, sf), fx.pads(spark, sf), fx.AS_OF)
    return fc.with_rounded(out, sql.LAUNCH_ROUND4, 4)


@register("flow_quality_branch", sql.launches)
def q_flow_quality_branch(spark, sf):
    return _launch_flow(spark, sf)


def _launch_view(name, cols):
    @register(name, lambda: sql.launches(cols))
    def q(spark, sf):
        return _launch_flow(spark, sf).select(*cols)
    q.__name__ = f"q_{name}"
    return q


_launch_view("left_join_dims", ["flight_number", "rocket_id", "rocket_name", "cost_per_launch",
                                "launchpad_id", "launchpad_name", "region"])
_launch_view("tri_state", ["flight_number", "success", "mission_outcome"])
_launch_view("complexity", ["flight_number", "crew", "payloads", "completeness_score", "mission_complexity"])
_launch_view("reliability", ["flight_number", "success_rate", "completeness_score", "reliability_score"])
_launch_view("completeness", ["flight_number", "completeness_score", "processing_tier"])
_launch_view("group_transform", ["flight_number", "rocket_name", "launchpad_name", "avg_success_rate_by_rocket",
                                 "launches_by_rocket", "avg_success_rate_by_pad"])
_launch_view("safe_div", ["flight_number", "cost_per_launch", "payloads", "cost_per_payload"])
_launch_view("date_parts", ["flight_number", "date_utc", "launch_year", "launch_month", "launch_day_of_week"])
_launch_view("days_since", ["flight_number", "date_utc", "days_since_launch"])
_launch_view("constant_column", ["flight_number", "processing_tier"])


@register("top_k_recent", lambda: sql.with_ctes({"launches": sql.LAUNCH["launches"]}, """
SELECT flight_number, date_unix FROM launches ORDER BY coalesce(date_unix, 0) DESC, flight_number LIMIT 200"""))
def q_top_k_recent(spark, sf):
    l = fx.launches(spark, sf)
    return ranking.top_k(l, [F.coalesce("date_unix", F.lit(0)).desc(), F.col("flight_number")], 200).select(
        "flight_number", "date_unix")


@register("branch_split", lambda: sql.with_ctes({k: sql.LAUNCH[k] for k in ["launches", "rockets", "pads", "enriched", "scored"]}, """
SELECT flight_number, CASE WHEN coalesce(completeness_score >= 0.8, false) THEN 'complete' ELSE 'incomplete' END AS branch
FROM scored"""))
def q_branch_split(spark, sf):
    e = lf.enrich(fx.launches(spark, sf), fx.rockets(spark, sf), fx.pads(spark, sf))
    scored = e.withColumn("completeness_score", lf.completeness())
    t, f = cmb.split(scored, F.col("completeness_score") >= 0.8)
    return t.select("flight_number", F.lit("complete").alias("branch")).unionByName(
        f.select("flight_number", F.lit("incomplete").alias("branch")))


@register("branch_union", lambda: sql.with_ctes({k: sql.LAUNCH[k] for k in ["launches", "rockets", "pads", "enriched", "scored"]}, """
SELECT flight_number, CASE WHEN completeness_score >= 0.8 THEN cost_per_payload END AS cost_per_payload,
       CASE WHEN completeness_score < 0.8 THEN 'basic_metrics' END AS basic_tier
FROM scored"""))
def q_branch_union(spark, sf):
    e = lf.enrich(fx.launches(spark, sf), fx.rockets(spark, sf), fx.pads(spark, sf))
    scored = e.withColumn("completeness_score", lf.completeness())
    return cmb.branch_map(scored, F.col("completeness_score") >= 0.8,
                          lambda d: d.select("flight_number", "cost_per_payload"),
                          lambda d: d.select("flight_number", F.lit("basic_metrics").alias("basic_tier")))


@register("fallback_fill", lambda: sql.with_ctes({"rockets": sql.LAUNCH["rockets"]}, """
SELECT rocket_id, rocket_name, cost_per_launch, 'primary' AS source FROM rockets WHERE cost_per_launch IS NOT NULL
UNION ALL
SELECT rocket_id, rocket_name, NULL AS cost_per_launch, 'fallback' AS source FROM rockets r
WHERE NOT EXISTS (SELECT 1 FROM rockets p WHERE p.cost_per_launch IS NOT NULL AND p.rocket_id = r.rocket_id)"""))
def q_fallback_fill(spark, sf):
    rk = fx.rockets(spark, sf)
    primary = rk.filter(F.col("cost_per_launch").isNotNull()).select(
        "rocket_id", "rocket_name", "cost_per_launch", F.lit("primary").alias("source"))
    fallback = rk.select("rocket_id", "rocket_name", F.lit("fallback").alias("source"))
    return cmb.fallback_fill(primary, fallback, "rocket_id")


@register("semi_dim", lambda: sql.with_ctes({"launches": sql.LAUNCH["launches"], "rockets": sql.LAUNCH["rockets"]}, """
SELECT * FROM rockets WHERE rocket_id IN (SELECT rocket_id FROM launches)"""))
def q_semi_dim(spark, sf):
    return cmb.semi_dim(fx.rockets(spark, sf), fx.launches(spark, sf), "rocket_id")


@register("distinct_ids", lambda: sql.with_ctes({"launches": sql.LAUNCH["launches"]},
                                                "SELECT DISTINCT rocket_id FROM launches"))
def q_distinct_ids(spark, sf):
    return fx.launches(spark, sf).select("rocket_id").distinct()


@register("typed_empty", lambda: sql.with_ctes({"launches": sql.LAUNCH["launches"]}, """
SELECT flight_number, launchpad_id, CAST(NULL AS VARCHAR) AS launchpad_name, CAST(NULL AS VARCHAR) AS region
FROM launches"""))
def q_typed_empty(spark, sf):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("launchpad_id", T.IntegerType()),
                           T.StructField("launchpad_name", T.StringType()),
                           T.StructField("region", T.StringType())])
    empty = cmb.typed_empty(spark, schema)
    return fx.launches(spark, sf).select("flight_number", "launchpad_id").join(empty, "launchpad_id", "left")


# ---------------------------------------------------------------- retail and titles


def _r4(df, cols):
    return fc.with_rounded(df, cols, 4)


CROSS_COLS = ["age_group", "decade", "shopping_revenue", "shopping_transactions", "avg_shopping_amount",
              "gaming_sales_millions", "games_released", "avg_game_sales"]
CROSS_R4 = ["shopping_revenue", "avg_shopping_amount", "gaming_sales_millions", "avg_game_sales"]


@register("flow_retail_cross", lambda: sql.retail("SELECT " + sql.rounded_select(CROSS_COLS, CROSS_R4, "crossed")))
def q_flow_retail_cross(spark, sf):
    return _r4(rt.flow_retail_cross(fx.shopping(spark, sf), fx.titles(spark, sf)), CROSS_R4)


@register("cross_summary", lambda: sql.retail(
    "SELECT age_group, decade, shopping_transactions, games_released FROM crossed"))
def q_cross_summary(spark, sf):
    return rt.flow_retail_cross(fx.shopping(spark, sf), fx.titles(spark, sf)).select(
        "age_group", "decade", "shopping_transactions", "games_released")


@register("group_agg_domain", lambda: sql.retail("SELECT " + sql.rounded_select(
    ["age_group", "total_revenue", "transaction_count", "avg_transaction"], ["total_revenue", "avg_transaction"],
    "shop_summary")))
def q_group_agg_domain(spark, sf):
    s = rt.shopping_summary(rt.clean_shopping(fx.shopping(spark, sf)))
    return _r4(s, ["total_revenue", "avg_transaction"])


@register("group_agg", lambda: sql.retail("SELECT " + sql.rounded_select(
    ["decade", "total_sales_millions", "avg_sales", "game_count"], ["total_sales_millions", "avg_sales"],
    "games_summary")))
def q_group_agg(spark, sf):
    g = rt.games_summary(rt.clean_games(fx.titles(spark, sf)))
    return _r4(g, ["total_sales_millions", "avg_sales"])


def _shop_view(name, cols):
    @register(name, lambda: sql.retail(f"SELECT {', '.join(cols)} FROM shop"))
    def q(spark, sf):
        return rt.clean_shopping(fx.shopping(spark, sf)).select(*cols)
    q.__name__ = f"q_{name}"


def _games_view(name, cols):
    @register(name, lambda: sql.retail(f"SELECT {', '.join(cols)} FROM games"))
    def q(spark, sf):
        return rt.clean_games(fx.titles(spark, sf)).select(*cols)
    q.__name__ = f"q_{name}"


_shop_view("snake_case", ["invoice_no", "customer_id", "price", "quantity", "age"])
_shop_view("age_group", ["invoice_no", "customer_id", "age", "age_group"])
_shop_view("spending_tier", ["invoice_no", "price", "quantity", "total_amount", "spending_tier"])
_shop_view("row_arith", ["invoice_no", "price", "quantity", "total_amount"])
_shop_view("date_parse_coerce", ["invoice_no", "invoice_date", "year", "month", "day_of_week"])
_games_view("sales_category", ["rank", "global_sales", "sales_category"])
_games_view("coerce_numeric", ["rank", "na_sales", "eu_sales", "jp_sales", "other_sales", "year"])
_games_view("row_sum", ["rank", "na_sales", "eu_sales", "jp_sales", "other_sales", "global_sales"])
_games_view("row_argmax", ["rank", "na_sales", "eu_sales", "jp_sales", "other_sales", "primary_market"])
_games_view("decade", ["rank", "year", "decade"])


# ---------------------------------------------------------------- weather

WEATHER_COLS = ["event_id", "region", "city", "time", "date", "hour", "temperature_2m", "relative_humidity_2m",
                "precipitation", "wind_speed_10m", "weather_type", "comfort_index", "wind_category"]


@register("flow_weather", lambda: sql.weather(f"SELECT {', '.join(WEATHER_COLS)} FROM final", sample=False))
def q_flow_weather(spark, sf):
    return wf.flow_weather(fx.regional_rows(spark, sf)).select(*WEATHER_COLS)


@register("systematic_sample", lambda: sql.weather("SELECT event_id, region FROM sampled"))
def q_systematic_sample(spark, sf):
    return ranking.systematic_sample(fx.regional_rows(spark, sf), [F.col("region"), F.col("time"), F.col("event_id")], 200).select(
        "event_id", "region")


@register("fan_in_union", lambda: sql.weather("SELECT event_id, region, city FROM merged"))
def q_fan_in_union(spark, sf):
    from rillet.sources.files import fan_in
    return fan_in(fx.regional_feeds(spark, sf), "region").select("event_id", "region", "city")


def _weather_view(name, cols):
    @register(name, lambda: sql.weather(f"SELECT {', '.join(cols)} FROM final", sample=False))
    def q(spark, sf):
        return wf.flow_weather(fx.regional_rows(spark, sf)).select(*cols)
    q.__name__ = f"q_{name}"


_weather_view("weather_type", ["event_id", "precipitation", "temperature_2m", "weather_type"])
_weather_view("comfort_index", ["event_id", "temperature_2m", "relative_humidity_2m", "comfort_index"])
_weather_view("wind_category", ["event_id", "wind_speed_10m", "wind_category"])
_weather_view("date_hour", ["event_id", "time", "date", "hour"])

_HOURLY_SCHEMA = ("struct<event_id: array<bigint>, time: array<timestamp_ntz>, temperature_2m: array<double>, "
                  "relative_humidity_2m: array<double>, precipitation: array<double>, wind_speed_10m: array<double>>")


@register("json_arrays_to_rows", lambda: sql.with_ctes({"wrows": sql.WEATHER["wrows"]}, """
SELECT event_id, time, temperature_2m, relative_humidity_2m, precipitation, wind_speed_10m FROM wrows"""))
def q_json_arrays_to_rows(spark, sf):
    docs = rs.parse_json(fx.weather_documents(spark, sf), "hourly_json", _HOURLY_SCHEMA, "hourly", ["doc_id"],
                         {"timestampNTZFormat": fx.JSON_TS})
    return rs.arrays_to_rows(docs, "hourly", ["event_id", "time"] + fx.HOURLY_MEASURES)


# ---------------------------------------------------------------- pages, listings, creatures, parents

POST_COLS = ["page_no", "story_id", "title", "url", "points", "author", "age", "comments", "source",
             "engagement_score", "popularity", "is_external"]


def _posts(spark, sf):
    return pgf.flow_posts(fx.story_pages(spark, sf))


@register("flow_posts", lambda: sql.with_ctes(sql.POSTS, f"SELECT {', '.join(POST_COLS)} FROM posts"))
def q_flow_posts(spark, sf):
    return _posts(spark, sf).select(*POST_COLS)


def _post_view(name, cols):
    @register(name, lambda: sql.with_ctes(sql.POSTS, f"SELECT {', '.join(cols)} FROM posts"))
    def q(spark, sf):
        return _posts(spark, sf).select(*cols)
    q.__name__ = f"q_{name}"


_post_view("clean_url", ["story_id", "url"])
_post_view("url_host", ["story_id", "url", "source"])
_post_view("popularity", ["story_id", "points", "comments", "engagement_score", "popularity"])
_post_view("regex_flag", ["story_id", "url", "is_external"])
_post_view("required_fields", ["story_id", "title"])


@register("html_extract", lambda: sql.with_ctes({"b": """
SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) AS href,
       unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2)) AS text,
       CAST(unnest(generate_series(0, len(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) - 1))
            AS INTEGER) AS pos
FROM pages"""}, "SELECT page_id, pos, href, text FROM b"))
def q_html_extract(spark, sf):
    return htm.extract_blocks(fx.table(spark, sf, "pages"), "html", htm.LINK_BLOCK, {"href": 1, "text": 2},
                              ["page_id"])


LISTING_COLS = ["listing_id", "name", "price", "total_reviews", "price_usd", "review_count"]


@register("flow_listings", lambda: sql.with_ctes(sql.LISTINGS, f"SELECT {', '.join(LISTING_COLS)} FROM lst"))
def q_flow_listings(spark, sf):
    return pgf.flow_listings(fx.listings(spark, sf)).select(*LISTING_COLS)


@register("rename_map", lambda: sql.with_ctes(sql.LISTINGS, "SELECT listing_id, name, price, total_reviews FROM lst"))
def q_rename_map(spark, sf):
    from rillet.functions.columns import renamed
    return renamed(fx.listings(spark, sf), pgf.LISTING_RENAME)


@register("parse_price", lambda: sql.with_ctes(sql.LISTINGS, "SELECT listing_id, price, price_usd FROM lst"))
def q_parse_price(spark, sf):
    return pgf.flow_listings(fx.listings(spark, sf)).select("listing_id", "price", "price_usd")


@register("extract_count", lambda: sql.with_ctes(sql.LISTINGS, "SELECT listing_id, total_reviews, review_count FROM lst"))
def q_extract_count(spark, sf):
    return pgf.flow_listings(fx.listings(spark, sf)).select("listing_id", "total_reviews", "review_count")


CREATURE_COLS = ["pokemon_id", "name", "height", "weight", "base_experience", "hp", "attack", "defense",
                 "special_attack", "special_defense", "speed", "type_primary", "type_secondary", "is_legendary",
                 "is_mythical", "generation", "total_stats", "rarity", "legendary_tier", "power_score", "combat_role"]


def _creatures(spark, sf):
    return crf.flow_legendary(fx.creature_documents(spark, sf), fx.species_documents(spark, sf))


@register("flow_legendary", lambda: sql.with_ctes(sql.CREATURES, f"SELECT {', '.join(CREATURE_COLS)} FROM cr"))
def q_flow_legendary(spark, sf):
    return _creatures(spark, sf).select(*CREATURE_COLS)


def _creature_view(name, cols, src="cr"):
    @register(name, lambda: sql.with_ctes(sql.CREATURES, f"SELECT {', '.join(cols)} FROM {src}"))
    def q(spark, sf):
        return _creatures(spark, sf).select(*cols)
    q.__name__ = f"q_{name}"


_creature_view("title_case", ["pokemon_id", "name"])
_creature_view("rarity", ["pokemon_id", "total_stats", "is_legendary", "is_mythical", "rarity"])
_creature_view("combat_role", ["pokemon_id", "attack", "defense", "speed", "hp", "combat_role"])
_creature_view("legendary_tier", ["pokemon_id", "total_stats", "legendary_tier"])
_creature_view("weighted_score", ["pokemon_id", "total_stats", "base_experience", "power_score"])
_creature_view("stat_total", ["pokemon_id", "hp", "attack", "defense", "special_attack", "special_defense",
                              "speed", "total_stats"])
_creature_view("json_lookup_join", ["pokemon_id", "is_legendary", "is_mythical", "generation"])


@register("json_flatten", lambda: sql.with_ctes(sql.CREATURES, "SELECT pokemon_id, name, height, weight, "
          "base_experience, hp, attack, defense, special_attack, special_defense, speed, type_primary, "
          "type_secondary FROM ent"))
def q_json_flatten(spark, sf):
    return crf.flatten(fx.creature_documents(spark, sf)).drop("species_url", "n_stats", "n_types")


@register("json_array_sizes", lambda: sql.with_ctes(sql.CREATURES, "SELECT pokemon_id, n_stats, n_types FROM ent"))
def q_json_array_sizes(spark, sf):
    return crf.flatten(fx.creature_documents(spark, sf)).select("pokemon_id", "n_stats", "n_types")


@register("json_corrupt_records", "SELECT 20 AS length, count(*) AS n FROM part WHERE p_partkey % 53 = 11")
def q_json_corrupt_records(spark, sf):
    bad = rs.corrupt_records(fx.creature_documents(spark, sf), "json", crf.ENTITY_SCHEMA)
    return bad.groupBy(F.length("_corrupt_record").alias("length")).agg(F.count("*").alias("n"))


@register("json_array_text", """
SELECT p_partkey AS pokemon_id, CASE WHEN p_size > 25 THEN '["' || lower(p_type) || '","' || lower(replace(p_brand, '#', '-')) || '"]'
       ELSE '["' || lower(p_type) || '"]' END AS types FROM part WHERE p_partkey % 53 <> 11""")
def q_json_array_text(spark, sf):
    docs = fx.creature_documents(spark, sf).filter(~rs.is_corrupt("json", crf.ENTITY_SCHEMA))
    e = rs.parse_json(docs, "json", crf.ENTITY_SCHEMA, "e").select("e.id", F.col("e.types.type.name").alias("names"))
    return e.select(F.col("id").alias("pokemon_id"), rs.arrays_as_text({"types": "names"})["types"].alias("types"))


@register("json_children_of", """
SELECT 'p-2' AS pipeline_id, event_id AS stage_id, event_type AS stage_type,
       CAST(row_number() OVER (ORDER BY event_id) AS INTEGER) AS stage_number
FROM events WHERE event_id // 24 = 2""")
def q_json_children_of(spark, sf):
    schema = ("struct<pipeline_id: string, stages: array<struct<stage_id: bigint, stage_type: string, "
              "stage_number: int>>>")
    docs = rs.parse_json(fx.catalogue_documents(spark, sf), "json", schema, "d").select("d.*")
    return rs.child_rows(docs, "pipeline_id", "stages", parent_id="p-2")


@register("named_csv", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'F'""")
def q_named_csv(spark, sf):
    """One data set, by name, of a folder with a CSV data set for each order status; types inferred."""
    path = _landed(spark, "orders_by_status")
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    sinks.replace_files(orders, path, fmt="csv", partition_by=["o_orderstatus"])
    return fs.read_csv(spark, f"{path}/o_orderstatus=F")


@register("scan_csv_split", "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag, l_shipdate FROM lineitem")
def q_scan_csv_split(spark, sf):
    """CSV files without line breaks in values, each of them split between tasks."""
    path = _landed(spark, "lineitem_csv")
    lines = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    sinks.replace_files(lines, path, fmt="csv")
    return fs.read_csv(spark, path, lines.schema, multi_line=False)


@register("several_sinks", """
SELECT o_orderstatus AS dataset, o_orderkey, o_custkey, o_orderpriority, TIMESTAMP '2025-01-01 00:00:00' AS processed_at FROM orders""")
def q_several_sinks(spark, sf):
    """One stamped export per order status; a status without orders has no export, and an export that
    fails does not stop the others. The exports that were made are read back under their names."""
    path, orders = _landed(spark, "orders_exports"), fx.table(spark, sf, "orders")
    stamped = sinks.with_processing_time(orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"), as_of=fx.AS_OF)
    frames = {k: stamped.filter(F.col("o_orderstatus") == k).drop("o_orderstatus") for k in ("F", "O", "P", "none")}
    frames["broken"] = stamped.select("o_orderkey", F.raise_error(F.lit("no such rate")).alias("rate"))
    try:
        sinks.write_many(frames, lambda name, df: sinks.replace_files(df, f"{path}/{name}"))
        raise RuntimeError("a broken export went through")
    except sinks.SinksFailed as e:
        if set(e.failed) != {"broken"}:
            raise
        return fs.read_paths_tagged(spark, {name: f"{path}/{name}" for name in e.done}, tag="dataset")


@register("replaced_table", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1000 AS c_acctbal FROM customer WHERE c_acctbal + 1000 > 0""")
def q_replaced_table(spark, sf):
    """A catalog table replaced by rows made from itself: written beside it, compared by content, then renamed."""
    name = f"rillet_customers_{uuid.uuid4().hex[:8]}"
    sinks.replace_table(fx.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), name)
    sinks.replace_table(spark.table(name).withColumn("c_acctbal", F.col("c_acctbal") + 1000).filter("c_acctbal > 0"), name)
    return spark.table(name)


def _parents(spark, sf):
    return prf.profiles(fx.parents(spark, sf), fx.children(spark, sf))


PARENT_COLS = ["parent_id", "has_special", "n_children", "n_types", "complexity"]


@register("parent_profile", lambda: sql.with_ctes(sql.PARENTS, f"SELECT {', '.join(PARENT_COLS)} FROM par"))
def q_parent_profile(spark, sf):
    return _parents(spark, sf).select(*PARENT_COLS)


@register("tags_contain_all", lambda: sql.with_ctes(sql.PARENTS,
          "SELECT parent_id, complexity FROM par WHERE has_special AND has_open"))
def q_tags_contain_all(spark, sf):
    return prf.filter_tags(_parents(spark, sf), ["Branching", "Transform"]).select("parent_id", "complexity")


@register("tags_by_source", lambda: sql.with_ctes(sql.PARENTS,
          "SELECT parent_id, source_type FROM par WHERE source_type = 'web_scraping' AND has_open"))
def q_tags_by_source(spark, sf):
    return prf.filter_tags(_parents(spark, sf), ["Web Scraping", "Transform"]).select("parent_id", "source_type")


TAG_SETS = {"open branches": ["Branching", "Transform"], "scraped": ["Web Scraping"], "all of it": ["API", "Branching", "Transform", "Database"]}


@register("tags_by_index", lambda: sql.with_ctes(sql.PARENTS, """
SELECT 'open branches' AS name, parent_id FROM par WHERE has_special AND has_open
UNION ALL SELECT 'scraped', parent_id FROM par WHERE source_type = 'web_scraping'
UNION ALL SELECT 'all of it', parent_id FROM par WHERE source_type = 'api' AND has_special AND has_open AND has_filled"""))
def q_tags_by_index(spark, sf):
    """Several tag sets answered by one index of tag bitmaps."""
    path = _landed(spark, "tag_index")
    lookup.write_tag_index(prf.with_tags(_parents(spark, sf)), path, "parent_id", "tags")
    return lookup.ids_by_set(spark.read.parquet(path), TAG_SETS).withColumnRenamed("id", "parent_id")


_LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@register("page_by_directory", f"""
SELECT row_no, l_shipdate, l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT *, row_number() OVER (ORDER BY {', '.join(_LINE_ORDER)}) AS row_no FROM lineitem) t
WHERE row_no BETWEEN 2001 AND 2025 OR row_no > (SELECT count(*) FROM lineitem) - 25""")
def q_page_by_directory(spark, sf):
    """An early and the last page of 25 rows of one ordered listing of all lines, from one written directory."""
    path = _landed(spark, "line_pages")
    lines = fx.table(spark, sf, "lineitem")
    lookup.write_pages(lines, path, _LINE_ORDER)
    total = lines.count()
    pages = lookup.read_page(spark, path, 2000, 25).unionByName(lookup.read_page(spark, path, total - 25, 25))
    return pages.select(F.col("row_no"), "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")


@register("series_lookup", """
SELECT l_suppkey AS symbol, l_shipdate AS timestamp, CAST(sum(l_quantity) AS BIGINT) AS volume FROM lineitem
WHERE l_suppkey % 10 = 3 AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31' GROUP BY ALL""")
def q_series_lookup(spark, sf):
    """Daily bars of some symbols in a range of days, from a table laid out for such lookups."""
    path = _landed(spark, "bars_series")
    lookup.write_series(fx.bars(spark, sf).withColumn("year", F.year("timestamp")), path, "symbol", "timestamp", ["year"])
    days = [F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1998-12-31")]
    wanted = spark.read.parquet(path).filter(F.col("year").between(1996, 1998) & F.col("timestamp").between(*days))
    return wanted.filter(F.pmod("symbol", F.lit(10)) == 3).select("symbol", "timestamp", "volume")


@register("ordinal_sort", lambda: sql.with_ctes(sql.PARENTS, """
SELECT parent_id, complexity, CASE complexity WHEN 'beginner' THEN 0 WHEN 'intermediate' THEN 1
  WHEN 'advanced' THEN 2 ELSE 3 END AS complexity_rank FROM par ORDER BY complexity_rank, parent_id"""))
def q_ordinal_sort(spark, sf):
    p = _parents(spark, sf).withColumn("complexity_rank", ranking.ordinal_key("complexity", prf.COMPLEXITY_ORDER))
    return p.select("parent_id", "complexity", "complexity_rank").orderBy("complexity_rank", "parent_id")


@register("page", lambda: sql.with_ctes(sql.PARENTS, """
SELECT parent_id, complexity FROM par ORDER BY CASE complexity WHEN 'beginner' THEN 0 WHEN 'intermediate' THEN 1
  WHEN 'advanced' THEN 2 ELSE 3 END, parent_id LIMIT 10 OFFSET 20"""))
def q_page(spark, sf):
    return prf.complexity_page(_parents(spark, sf), 20, 10).select("parent_id", "complexity")


@register("group_index", """
SELECT l_orderkey AS parent_id, l_linenumber AS stage_number, l_returnflag AS stage_type,
       CAST((dense_rank() OVER (PARTITION BY l_orderkey ORDER BY f, k) - 1) % 6 AS INTEGER) AS colour_index
FROM (SELECT *, min(l_linenumber) OVER (PARTITION BY l_orderkey, k) AS f
      FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN l_returnflag ELSE CAST(l_linenumber AS VARCHAR) END AS k FROM lineitem) u) t""")
def q_group_index(spark, sf):
    return prf.group_colours(fx.children(spark, sf)).select("parent_id", "stage_number", "stage_type", "colour_index")


# ---------------------------------------------------------------- sources, sinks and generic operators


def _landed(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/landed/{name}-{uuid.uuid4().hex}"


_PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@register("scan_csv", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def q_scan_csv(spark, sf):
    path = _landed(spark, "part_csv")
    sinks.replace_files(fx.table(spark, sf, "part"), path, fmt="csv")
    return fs.read_csv(spark, path, _PART_SCHEMA)


@register("write_read_back", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def q_write_read_back(spark, sf):
    path = _landed(spark, "orders_parquet")
    sinks.replace_files(fx.table(spark, sf, "orders"), path, partition_by=["o_orderstatus"],
                        sort_within=["o_orderdate"])
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                           "o_orderdate", "o_orderpriority")


@register("json_zip_default", """
WITH e AS (SELECT *, event_id // 24 AS doc_id, CAST(epoch_us(ts) // 1000 AS DOUBLE) AS ts_ms FROM events),
p AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY event_id) - 1 AS pos, ts_ms, value FROM e),
v AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY event_id) - 1 AS pos, value * 2 AS vol
      FROM e WHERE event_type <> 'error')
SELECT p.doc_id, CAST(p.pos AS INTEGER) AS pos, p.ts_ms, p.value, coalesce(v.vol, 0.0::DOUBLE) AS partner_value
FROM p LEFT JOIN v USING (doc_id, pos)""")
def q_json_zip_default(spark, sf):
    docs = rs.parse_json(fx.chart_documents(spark, sf), "json",
                         "struct<prices: array<array<double>>, total_volumes: array<array<double>>>", "c", ["doc_id"])
    flat = docs.select("doc_id", F.col("c.prices").alias("prices"), F.col("c.total_volumes").alias("total_volumes"))
    return rs.zip_with_default(flat, "prices", "total_volumes", ["doc_id"])


@register("json_map_to_rows", """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_retailprice AS usd, CAST(p_size AS DOUBLE) AS usd_24h_vol FROM part""")
def q_json_map_to_rows(spark, sf):
    schema = T.StructType([T.StructField("usd", T.DoubleType()), T.StructField("usd_24h_vol", T.DoubleType())])
    return rs.keyed_object_to_rows(fx.spot_documents(spark, sf), "json", schema)


@register("json_map_wanted", """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_retailprice AS usd, CAST(p_size AS DOUBLE) AS usd_24h_vol FROM part
WHERE p_partkey IN (3, 7, 21)""")
def q_json_map_wanted(spark, sf):
    schema = T.StructType([T.StructField("usd", T.DoubleType()), T.StructField("usd_24h_vol", T.DoubleType())])
    return rs.keyed_object_to_rows(fx.spot_documents(spark, sf), "json", schema, wanted=["3", "7", "21"])


@register("json_parent_child", """
SELECT 'p-' || CAST(event_id // 24 AS VARCHAR) AS pipeline_id, event_id AS stage_id, event_type AS stage_type,
       CAST(row_number() OVER (PARTITION BY event_id // 24 ORDER BY event_id) AS INTEGER) AS stage_number
FROM events""")
def q_json_parent_child(spark, sf):
    schema = ("struct<pipeline_id: string, stages: array<struct<stage_id: bigint, stage_type: string, "
              "stage_number: int>>>")
    docs = rs.parse_json(fx.catalogue_documents(spark, sf), "json", schema, "d").select("d.*")
    return rs.child_rows(docs, "pipeline_id", "stages")


@register("epoch_to_ts", """
SELECT event_id, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS ts_seconds,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts_millis, CAST(ts AS DATE) AS day
FROM events""")
def q_epoch_to_ts(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("_t"))
    secs, millis = F.unix_seconds("_t"), F.unix_millis("_t")
    return ev.select("event_id", fc.epoch_seconds_to_ts(secs).cast("timestamp_ntz").alias("ts_seconds"),
                     fc.epoch_millis_to_ts(millis).cast("timestamp_ntz").alias("ts_millis"),
                     F.to_date(fc.epoch_millis_to_ts(millis)).alias("day"))


@register("sql_query", """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS sum_qty FROM lineitem
GROUP BY l_returnflag, l_linestatus""")
def q_sql_query(spark, sf):
    fx.table(spark, sf, "lineitem").createOrReplaceTempView("rillet_lineitem")
    return fs.sql_query(spark, "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS sum_qty "
                               "FROM rillet_lineitem GROUP BY l_returnflag, l_linestatus")


@register("time_range_scan", """
SELECT event_id, ts, event_type, value FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAY AND TIMESTAMP '2024-01-30 00:00:00'""")
def q_time_range_scan(spark, sf):
    as_of = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    ev = fx.table(spark, sf, "events")
    return ev.filter(F.col("ts").between(as_of - F.expr("INTERVAL 7 DAYS"), as_of)).select(
        "event_id", "ts", "event_type", "value")


@register("export_json_types", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate
FROM orders""")
def q_export_json_types(spark, sf):
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                            F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"),
                                            "o_orderdate")
    return sinks.export_shape(o, ["o_orderkey"])


@register("limit_k", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice LIMIT 200""")
def q_limit_k(spark, sf):
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    return fx.table(spark, sf, "lineitem").select(*cols).orderBy(*cols).limit(200)


@register("drop_nulls", lambda: sql.with_ctes({"launches": sql.LAUNCH["launches"]}, """
SELECT * FROM launches WHERE COLUMNS(*) IS NOT NULL"""))
def q_drop_nulls(spark, sf):
    return fx.launches(spark, sf).na.drop("any")


@register("fill_null", lambda: sql.with_ctes({"rockets": sql.LAUNCH["rockets"]}, """
SELECT rocket_id, coalesce(cost_per_launch, 0.0::DOUBLE) AS cost_per_launch,
       coalesce(success_rate, 50.0::DOUBLE) AS success_rate FROM rockets"""))
def q_fill_null(spark, sf):
    return fx.rockets(spark, sf).select("rocket_id", "cost_per_launch", "success_rate").fillna(
        {"cost_per_launch": 0.0, "success_rate": 50.0})


@register("global_agg", lambda: sql.threat(None).replace("SELECT * FROM threat", """
SELECT round_even(avg(risk_score) * 10000, 0) / 10000 AS mean_risk, max(risk_score) AS max_risk,
       min(risk_score) AS min_risk, CAST(count_if(requires_investigation) AS BIGINT) AS n_investigate FROM threat"""))
def q_global_agg(spark, sf):
    t = _scored(fx.packets(spark, sf))
    return t.agg(fc.round_half_even(F.avg("risk_score"), 4).alias("mean_risk"), F.max("risk_score").alias("max_risk"),
                 F.min("risk_score").alias("min_risk"), F.count_if("requires_investigation").alias("n_investigate"))


@register("value_counts", lambda: sql.threat(None).replace("SELECT * FROM threat", """
SELECT threat_level, count(*) AS count FROM threat WHERE threat_level IS NOT NULL GROUP BY threat_level"""))
def q_value_counts(spark, sf):
    return agg.value_counts(_scored(fx.packets(spark, sf)), "threat_level")


_PROFILE_COLS = ["flight_number", "success", "details", "rocket_id", "payloads"]


@register("null_profile", lambda: sql.with_ctes({"launches": sql.LAUNCH["launches"]}, " UNION ALL ".join(
    f"SELECT count(*) AS rows, '{c}' AS column_name, count({c}) AS non_null FROM launches" for c in _PROFILE_COLS)))
def q_null_profile(spark, sf):
    return agg.null_profile(fx.launches(spark, sf), _PROFILE_COLS)


@register("union_all", lambda: sql.with_ctes({"hourly": sql.MARKET["hourly"], "daily": sql.MARKET["daily"]}, """
SELECT crypto_id, price_usd, volume, 'hourly' AS grain FROM hourly
UNION ALL SELECT crypto_id, price_usd, volume, 'daily' AS grain FROM daily"""))
def q_union_all(spark, sf):
    h = fx.hourly(spark, sf).select("crypto_id", "price_usd", "volume", F.lit("hourly").alias("grain"))
    d = fx.daily(spark, sf).select("crypto_id", "price_usd", "volume", F.lit("daily").alias("grain"))
    return cmb.union_branches(h, d)


@register("mean_std", lambda: sql.with_ctes({"daily": sql.MARKET["daily"]}, """
SELECT crypto_id, round_even(avg(price_usd) * 10000, 0) / 10000 AS mean_price,
       round_even(stddev_samp(price_usd) * 10000, 0) / 10000 AS std_price, count(*) AS n
FROM daily GROUP BY crypto_id"""))
def q_mean_std(spark, sf):
    d = fx.daily(spark, sf)
    return d.groupBy("crypto_id").agg(fc.round_half_even(F.avg("price_usd"), 4).alias("mean_price"),
                                      fc.round_half_even(F.stddev_samp("price_usd"), 4).alias("std_price"),
                                      F.count(F.lit(1)).alias("n"))


@register("json_optional_fields", """
SELECT c_custkey AS id, c_name AS name, CASE WHEN c_acctbal >= 0 THEN c_acctbal / 100.0::DOUBLE END AS height_meters,
       CASE WHEN c_nationkey % 2 = 0 THEN CAST(c_nationkey AS BIGINT) ELSE 0 END AS boosters
FROM customer""")
def q_json_optional_fields(spark, sf):
    schema = "struct<id: bigint, name: string, height: struct<meters: double>, boosters: bigint>"
    d = rs.parse_json(fx.rocket_documents(spark, sf), "json", schema, "r")
    return d.select(F.col("r.id").alias("id"), F.col("r.name").alias("name"),
                    F.col("r.height.meters").alias("height_meters"),
                    F.coalesce(F.col("r.boosters"), F.lit(0).cast("long")).alias("boosters"))


@register("export_read_back", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate
FROM orders""")
def q_export_read_back(spark, sf):
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                            F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"),
                                            "o_orderdate")
    path = _landed(spark, "orders_export")
    written = sinks.export_json(o, path, ["o_orderkey"])
    df, n = fs.read_exported_json(spark, {"orders": path}, "orders")
    if n != written:
        raise RuntimeError("export read-back count differs")
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@register("export_array_read_back", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate
FROM orders""")
def q_export_array_read_back(spark, sf):
    """Indented JSON arrays whose objects hold an object each, written, read back and flattened."""
    o = fx.table(spark, sf, "orders").select("o_orderkey", F.struct("o_custkey", "o_orderstatus").alias("customer"),
                                            F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"), "o_orderdate")
    path = _landed(spark, "orders_array")
    written = ja.write_json_array(sinks.export_shape(o, ["o_orderkey"]), path, ["o_orderkey"], rows_per_file=1 << 13)
    df, n = fs.read_exported_json(spark, {"orders": path}, "orders")
    if n != written:
        raise RuntimeError("export read-back count differs")
    return df.select("o_orderkey", "customer.o_custkey", "customer.o_orderstatus", "o_totalprice", "o_orderdate")


@register("export_array_one_line", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_export_array_one_line(spark, sf):
    """JSON arrays without line breaks, of whole texts with quotes, braces and escapes, written and read back."""
    path = _landed(spark, "documents_array")
    docs = fx.table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    ja.write_json_array(docs, path, ["doc_id"], pretty=False, rows_per_file=1 << 12)
    return ja.read_json_array(spark, path, docs.schema)


@register("paged_source", "SELECT page_id, url, page_id % 7 + 1 AS page_no FROM pages")
def q_paged_source(spark, sf):
    path = _landed(spark, "pages_paged")
    pages = fx.table(spark, sf, "pages").select("page_id", "url", F.pmod("page_id", F.lit(7)).alias("batch"))
    sinks.replace_files(pages.repartition("batch"), path, partition_by=["batch"])  # one file for each batch
    return fs.read_pages(spark, path).select("page_id", "url", "page_no")
