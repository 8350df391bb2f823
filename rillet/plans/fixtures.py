"""Inputs for the flows, derived by Spark from the driver tables.

Each builder reads whole tables (no id subsets, no caps) and returns a
DataFrame in the shape the corresponding flow expects (FIXTURES.md), so the
work grows with the data. The DuckDB oracle builds the same views in
``rillet.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unit_price() -> F.Column:
    return F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: one row per (supplier, ship day).

    open/close are the unit prices of the first/last line in
    (order, part, line number, unit price) order; volume is the summed quantity.
    The group-by is partially aggregated before the shuffle, so a hot
    (symbol, day) is combined map-side.
    """
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("symbol"), F.col("l_shipdate").alias("timestamp"),
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", unit_price().alias("unit"))
    rank = F.struct("l_orderkey", "l_partkey", "l_linenumber", "unit")
    return li.groupBy("symbol", "timestamp").agg(
        F.min(rank)["unit"].alias("open"),  # the rank holds the price, so buffers carry it once
        F.max("unit").alias("high"),
        F.min("unit").alias("low"),
        F.max(rank)["unit"].alias("close"),
        F.sum("l_quantity").cast("long").alias("volume"))


# ---------------------------------------------------------------- market grains

AS_OF_HOURLY = "2001-01-01 00:00:00"


def traded_price(part: str) -> F.Column:
    """Unit price; every 50th part always trades at one price."""
    return F.when(F.pmod(part, F.lit(50)) == 7, F.pmod(part, F.lit(100)) + 900.0).otherwise(unit_price())


def spot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spot snapshot per part: list price (every 4th part far above its trades, every 50th
    at its one price) and traded quantity (every 3rd part: of a mean day)."""
    part = table(spark, sf_dir, "part")
    vol = (table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("crypto_id"))
           .agg(F.when(F.pmod("l_partkey", F.lit(3)) == 0, F.avg("l_quantity")).otherwise(F.sum("l_quantity")).alias("volume_24h")))
    key = F.col("p_partkey")
    price = (F.when(F.pmod(key, F.lit(50)) == 7, F.pmod(key, F.lit(100)) + 900.0).when(F.pmod(key, F.lit(4)) == 1, F.col("p_retailprice") * 40)
             .otherwise(F.col("p_retailprice")))
    return (part.select(key.alias("crypto_id"), F.col("p_brand").alias("symbol"), price.alias("spot_price_usd"))
            .join(vol, "crypto_id", "left").fillna(0.0, subset=["volume_24h"]))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fine grain: line unit prices shipped from 2001 on (pushed to the scan)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.filter(F.col("l_shipdate") >= F.lit(AS_OF_HOURLY).cast("timestamp_ntz"))
            .select(F.col("l_partkey").alias("crypto_id"), F.col("l_shipdate").alias("timestamp"),
                    traded_price("l_partkey").alias("price_usd"), F.col("l_quantity").alias("volume")))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coarse grain: every line's unit price."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("crypto_id"), F.to_date("l_shipdate").alias("date"),
                     traded_price("l_partkey").alias("price_usd"), F.col("l_quantity").alias("volume"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("crypto_id"), F.col("p_brand").alias("symbol"),
                       F.col("p_name").alias("name"), F.col("p_size").cast("long").alias("market_cap_rank"))


# ---------------------------------------------------------------- network packets

# Ports that stand in for source ports (picked by part key), and
# protocol labels picked by line and part number.
SOURCE_PORTS = [23, 80, 443, 135, 8080, 139, 22, 445, 1433, 3389, 5900, 53]
PROTOCOL_LABELS = ["TCP", "6", "UDP", "17", "ICMP", "1", "HTTP", "GRE"]


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One packet record per line item (sizes, ports, flags, spectral features,
    a label and one-hot protocol columns)."""
    li = table(spark, sf_dir, "lineitem")
    ports = F.array(*[F.lit(p) for p in SOURCE_PORTS])
    protos = F.array(*[F.lit(p) for p in PROTOCOL_LABELS])
    ip = F.concat_ws(".", F.pmod("l_orderkey", F.lit(256)), F.pmod("l_partkey", F.lit(256)),
                     F.pmod("l_suppkey", F.lit(256)), F.col("l_linenumber"))
    return li.select(
        F.col("l_orderkey").alias("flow_id"),
        (F.col("l_quantity") * 40).alias("packet_size"),
        F.element_at(ports, (F.pmod("l_partkey", F.lit(len(SOURCE_PORTS))) + 1).cast("int")).alias("src_port"),
        (F.col("l_suppkey") + 1000).cast("int").alias("dst_port"),
        F.col("l_extendedprice").alias("packet_count_5s"),
        (F.col("l_tax") + F.col("l_discount")).alias("spectral_entropy"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("frequency_band_energy"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_linestatus") == "O").cast("int").alias("protocol_type_tcp"),
        (F.col("l_returnflag") == "A").cast("int").alias("protocol_type_udp"),
        (F.col("l_returnflag") == "N").cast("int").alias("protocol_type_icmp"),
        (F.pmod("l_linenumber", F.lit(2)) == 1).cast("int").alias("tcp_flags_SYN"),
        (F.pmod("l_linenumber", F.lit(3)) == 0).cast("int").alias("tcp_flags_SYN-ACK"),
        F.when(F.col("l_linenumber") == 7, F.concat(ip, F.lit(".x"))).otherwise(ip).alias("src_ip"),
        F.element_at(protos, (F.pmod(F.col("l_linenumber") + F.col("l_partkey"), F.lit(len(PROTOCOL_LABELS))) + 1).cast("int")).alias("protocol"))


# ---------------------------------------------------------------- launches

LAUNCH_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
AS_OF = "2025-01-01 00:00:00"


def launches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One launch per order: tri-state success from the status, array sizes as
    line counts (pre-aggregated per order before the join), a UTC date text."""
    orders = table(spark, sf_dir, "orders")
    lines = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("payloads"),
                  F.count_if(F.col("l_returnflag") == "R").alias("crew"),
                  F.count_distinct("l_suppkey").alias("cores_used")))
    o = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    return o.select(
        F.col("o_orderkey").alias("flight_number"),
        F.concat(F.lit("mission-"), F.col("o_orderkey")).alias("name"),
        F.date_format("o_orderdate", LAUNCH_TS_FORMAT).alias("date_utc"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("date_unix"),
        F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
         .alias("success"),
        F.when(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderpriority")).alias("details"),
        F.col("o_custkey").alias("rocket_id"),
        F.pmod("o_orderkey", F.lit(30)).cast("int").alias("launchpad_id"),
        F.coalesce("crew", F.lit(0)).alias("crew"),
        F.coalesce("payloads", F.lit(0)).alias("payloads"),
        F.coalesce("cores_used", F.lit(0)).alias("cores_used"))


def rockets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("rocket_id"), F.col("c_name").alias("rocket_name"),
        F.col("c_mktsegment").alias("rocket_type"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("cost_per_launch"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey") * 4.0).alias("success_rate"))


def pads(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").alias("launchpad_id"), F.col("n_name").alias("launchpad_name"),
        F.col("r_name").alias("region"))


# ---------------------------------------------------------------- retail and titles

def shopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail rows with source-style headers (spaces, capitals), a US date text
    (bad on 7th lines), a unit price, a quantity and a customer age."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("l_orderkey").alias("Invoice No"),
        F.col("o_custkey").alias("Customer Id"),
        F.when(F.col("l_linenumber") == 7, F.lit("unknown"))
         .otherwise(F.date_format("l_shipdate", "M/d/yyyy")).alias("Invoice Date"),
        (unit_price() / 100.0).alias("Price"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.pmod("o_custkey", F.lit(110)).cast("int").alias("Age"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game titles with regional sales as text (some 'N/A') and a text year."""
    p = table(spark, sf_dir, "part")
    txt = lambda c: c.cast("string")
    return p.select(
        F.col("p_partkey").alias("Rank"),
        F.col("p_name").alias("Name"),
        txt(F.col("p_size") / 10.0).alias("NA_Sales"),
        txt(F.pmod("p_partkey", F.lit(7)) / 4.0).alias("EU_Sales"),
        F.when(F.pmod("p_partkey", F.lit(13)) == 0, F.lit("N/A"))
         .otherwise(txt((F.col("p_retailprice") - 900.0) / 50.0)).alias("JP_Sales"),
        txt(F.pmod("p_partkey", F.lit(3)) / 10.0).alias("Other_Sales"),
        F.when(F.col("p_size") == 1, F.lit("N/A"))
         .otherwise(txt(F.lit(1980) + F.pmod("p_partkey", F.lit(40)))).alias("Year"))


# ---------------------------------------------------------------- weather

# The event types act as the regional feeds, each with a city.
REGION_CITY = [("click", "Chiang Mai"), ("view", "Bangkok"), ("purchase", "Phuket"),
               ("signup", "Khon Kaen"), ("error", "Hat Yai")]
JSON_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
HOURLY_MEASURES = ["temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m"]


def weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly measures derived from the event stream, one row per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", F.col("event_type").alias("feed"), F.col("ts").alias("time"),
        (F.col("value") / 10.0 - 10.0).alias("temperature_2m"),
        F.get_json_object("props", "$.k").try_cast("double").alias("relative_humidity_2m"),
        F.when(F.pmod("event_id", F.lit(2)) == 0, F.col("value") / 40.0).otherwise(0.0).alias("precipitation"),
        (F.col("value") / 5.0).alias("wind_speed_10m"))


def weather_documents(spark: SparkSession, sf_dir: str, per_doc: int = 24) -> DataFrame:
    """Column-oriented documents (parallel arrays), ``per_doc`` consecutive
    events each: the group key is ``event_id // per_doc`` over a unique id, so
    no document holds more than ``per_doc`` entries."""
    rows = weather_rows(spark, sf_dir)
    grouped = rows.groupBy(F.floor(F.col("event_id") / per_doc).alias("doc_id"), "feed").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "time", *HOURLY_MEASURES))).alias("_items"))
    def field(n):
        return lambda x: x[n]
    hourly = F.struct(*[F.transform("_items", field(n)).alias(n) for n in ["event_id", "time"] + HOURLY_MEASURES])
    return grouped.select("doc_id", "feed", F.to_json(hourly, {"timestampNTZFormat": JSON_TS}).alias("hourly_json"))


def regional_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in one read, with their region (the event type) and its city."""
    city = F.create_map(*[F.lit(x) for pair in REGION_CITY for x in pair])
    return weather_rows(spark, sf_dir).withColumnRenamed("feed", "region").withColumn("city", F.try_element_at(city, F.col("region")))


def regional_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One source per known region, as separate reads for the fan-in operator."""
    rows = weather_rows(spark, sf_dir)
    return {region: rows.filter(F.col("feed") == region).drop("feed").withColumn("city", F.lit(city))
            for region, city in REGION_CITY}


# ---------------------------------------------------------------- story pages

def story_pages(spark: SparkSession, sf_dir: str, per_page: int = 30) -> DataFrame:
    """Listing pages of up to ``per_page`` stories, one story per event: a story row and a
    details row each, some without title, details, score, author, age or any link."""
    ev = table(spark, sf_dir, "events")
    i, k = F.col("event_id"), F.get_json_object("props", "$.k")
    every = lambda n, r: F.pmod(i, F.lit(n)) == r
    text = lambda *parts: F.concat(*[p if isinstance(p, F.Column) else F.lit(p) for p in parts])
    n = i.cast("string")
    link = (F.when(every(5, 0), text("item?id=", n)).when(every(5, 1), text("http://x", F.pmod(i, F.lit(9)), ".org/a?b=1"))
            .when(every(5, 2), F.lit("https://news.ycombinator.com/newest")).when(every(5, 3), text("https://site.example:8080/p/", n))
            .otherwise(text("https://www.host", F.pmod(i, F.lit(4)), ".com/", n, "#top")))
    title = F.when(every(17, 3), F.lit("")).otherwise(text(
        '<span class="titleline"><a href="', link, '" rel="nofollow"> The <i>', F.col("event_type"), "</i> &amp; &quot;", n, "&quot; </a></span>"))
    score = F.when(every(7, 2), F.lit("")).when(every(29, 7), F.lit('<span class="score">many points</span>')).otherwise(
        text('<span class="score" id="score_', n, '">', F.floor(F.col("value") * 3).cast("string"), " points</span> "))
    author = F.when(every(11, 4) | every(23, 9), F.lit("")).otherwise(text('by <a href="user?id=u', F.col("user_id"), '" class="hnuser">u', F.col("user_id"), "</a> "))
    age = F.when(every(13, 6) | every(23, 9), F.lit("")).otherwise(text('<span class="age"><a href="item?id=', n, '">', F.pmod(i, F.lit(24)), " hours ago</a></span> "))
    answers = F.when(every(23, 9), F.lit("")).otherwise(text('| <a href="item?id=', n, '">', F.when(every(3, 0), F.lit("discuss")).when(every(3, 1), text(k, "&nbsp;comments"))
                                                             .otherwise(F.lit("1&nbsp;comment")), "</a>"))
    details = F.when(every(19, 5), F.lit("<td>no details</td>")).otherwise(text('<td class="subtext"><span class="subline">', score, author, age, answers, "</span></td>"))
    story = text('<tr class="athing submission" id="', n, '"><td>', title, "</td></tr>\n<tr>", details, '</tr><tr class="spacer"></tr>\n')
    pages = ev.groupBy(F.floor(i / per_page).alias("p")).agg(F.array_sort(F.collect_list(F.struct(i.alias("i"), story.alias("s")))).alias("rows"))  # at most per_page rows
    return pages.select((F.col("p") + 1).alias("page_no"), text("<html><body><table>\n", F.array_join(F.transform("rows", lambda r: r["s"]), ""), "</table></body></html>").alias("html"))


# ---------------------------------------------------------------- listings

def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows with source headers, a money text and a review-count text."""
    p = table(spark, sf_dir, "part")
    price = F.col("p_retailprice") * F.col("p_size") / 10.0
    return p.select(
        F.col("p_partkey").alias("Listing Id"), F.col("p_name").alias("Resort Name"),
        F.concat(F.lit("US$"), F.format_number(price, 2)).alias("Price"),
        F.when(F.col("p_type") == "SMALL", F.lit("no reviews yet"))
         .otherwise(F.concat(F.col("p_size").cast("string"), F.lit(" reviews"))).alias("Reviews"))


# ---------------------------------------------------------------- creatures

def creature_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested JSON entity per part: six base stats, one or two types and a
    species reference by URL."""
    p = table(spark, sf_dir, "part")
    stats = F.array(*[F.struct((F.pmod(F.col("p_partkey") * (i + 3) + F.col("p_size"), F.lit(120)) + F.when(F.col("p_size") > 40, 80).otherwise(20))
                               .alias("base_stat")) for i in range(6)])
    t1 = F.struct(F.struct(F.lower("p_type").alias("name")).alias("type"))
    t2 = F.struct(F.struct(F.lower(F.regexp_replace("p_brand", "#", "-")).alias("name")).alias("type"))
    types = F.when(F.col("p_size") > 25, F.array(t1, t2)).otherwise(F.array(t1))
    # Keys that are null are left out of the text; a few documents are cut off.
    but = lambda c, n, r: F.when(F.pmod("p_partkey", F.lit(n)) != r, c)
    doc = F.struct(
        F.col("p_partkey").alias("id"), but(F.col("p_name"), 37, 5).alias("name"), but(F.col("p_size").cast("long"), 41, 6).alias("height"),
        F.col("p_retailprice").cast("long").alias("weight"), but((F.col("p_size") * 5).cast("long"), 43, 7).alias("base_experience"),
        stats.alias("stats"), types.alias("types"),
        F.struct(F.concat(F.lit("https://api.example/species/"), F.col("p_partkey")).alias("url")).alias("species"))
    whole = F.to_json(doc)
    return p.select(F.when(F.pmod("p_partkey", F.lit(53)) == 11, F.substring(whole, 1, 20)).otherwise(whole).alias("json"))


def species_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Species documents for the parts that have lines (others fail to resolve)."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.min("l_linenumber").alias("g"))
    doc = F.struct(
        F.concat(F.lit("https://api.example/species/"), F.col("l_partkey")).alias("url"),
        (F.col("n") >= 40).alias("is_legendary"), F.when(F.pmod("l_partkey", F.lit(23)) != 2, F.col("n") >= 45).alias("is_mythical"),
        F.when(F.pmod("l_partkey", F.lit(29)) != 3, F.struct(F.concat(F.lit("generation-"), F.col("g")).alias("name"))).alias("generation"))
    return g.select(F.to_json(doc).alias("json"))


# ---------------------------------------------------------------- parents and children

def parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent rows (orders) with the kind of source they read."""
    kind = F.when(F.col("o_orderstatus") == "O", "api").when(F.col("o_orderstatus") == "F", "file").otherwise("web_scraping")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("parent_id"), "o_orderpriority", kind.alias("source_type"))


def children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child rows (lines) of parent rows (orders): type, status and position."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("parent_id"), F.col("l_linenumber").alias("stage_number"),
                     F.col("l_returnflag").alias("stage_type"), F.col("l_linestatus").alias("stage_status"),
                     F.when(F.col("l_linestatus") == "O", F.col("l_returnflag")).alias("parallel_group"),
                     F.col("l_partkey").alias("child_id"))


# ---------------------------------------------------------------- bounded JSON documents

def _event_chunks(spark: SparkSession, sf_dir: str, per_doc: int = 24) -> DataFrame:
    """Events grouped into documents of at most ``per_doc`` consecutive ids
    (``event_id`` is unique), items sorted by id."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.floor(F.col("event_id") / per_doc).alias("doc_id")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "ts", "event_type", "value"))).alias("items"))


def chart_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``prices`` / ``total_volumes`` as ``[epoch_ms, value]`` lists; the volume
    list skips error events, so it is shorter than the price list."""
    docs = _event_chunks(spark, sf_dir)
    pair = lambda x, v: F.array(F.unix_millis(x["ts"].cast("timestamp")).cast("double"), v)
    prices = F.transform("items", lambda x: pair(x, x["value"]))
    vols = F.transform(F.filter("items", lambda x: x["event_type"] != "error"), lambda x: pair(x, x["value"] * 2))
    return docs.select("doc_id", F.to_json(F.struct(prices.alias("prices"), vols.alias("total_volumes"))).alias("json"))


def spot_documents(spark: SparkSession, sf_dir: str, per_doc: int = 20) -> DataFrame:
    """Keyed objects ``{id: {usd, usd_24h_vol}}``, at most ``per_doc`` ids each."""
    p = table(spark, sf_dir, "part")
    entry = F.struct(F.col("p_partkey").cast("string").alias("k"),
                     F.struct(F.col("p_retailprice").alias("usd"),
                              F.col("p_size").cast("double").alias("usd_24h_vol")).alias("v"))
    g = p.groupBy(F.floor(F.col("p_partkey") / per_doc).alias("doc_id")).agg(F.collect_list(entry).alias("e"))
    return g.select("doc_id", F.to_json(F.map_from_entries("e")).alias("json"))


def catalogue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent documents with a nested ``stages`` array (numbered from 1)."""
    docs = _event_chunks(spark, sf_dir)
    stages = F.transform("items", lambda x, i: F.struct(
        x["event_id"].alias("stage_id"), x["event_type"].alias("stage_type"),
        (i + 1).alias("stage_number")))
    doc = F.struct(F.concat(F.lit("p-"), F.col("doc_id")).alias("pipeline_id"), stages.alias("stages"))
    return docs.select(F.to_json(doc).alias("json"))


def rocket_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rocket JSON whose ``height`` object and ``boosters`` field may be absent
    (NULL fields are left out of the text)."""
    c = table(spark, sf_dir, "customer")
    doc = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") >= 0, F.struct((F.col("c_acctbal") / 100.0).alias("meters"))).alias("height"),
        F.when(F.pmod("c_nationkey", F.lit(2)) == 0, F.col("c_nationkey").cast("long")).alias("boosters"))
    return c.select(F.to_json(doc).alias("json"))
