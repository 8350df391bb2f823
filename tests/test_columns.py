"""Scalar functions on hand-written edge rows."""

import math

from pyspark.sql import functions as F

from rillet.functions import columns as fc


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first()["y"]


def test_round_half_even_matches_numpy(spark):
    import numpy as np
    vals = [2.675, 1.015, 0.125, -2.5, 1234.5678, 0.005, 2.5e-3, 10.0 / 3]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r["y"] for r in df.select(fc.round_half_even("x", 2).alias("y")).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]


def test_parse_money(spark):
    rows = [("US$32",), ("US$1,234",), ("",), ("n/a",), (None,), (" US$ 7.5 ",)]
    df = spark.createDataFrame(rows, "x string").select(fc.parse_money("x").alias("y"))
    assert [r["y"] for r in df.collect()] == [32.0, 1234.0, None, None, None, 7.5]


def test_first_int(spark):
    rows = [("1,234 reviews",), ("no digits",), ("42",), (None,)]
    df = spark.createDataFrame(rows, "x string").select(fc.first_int("x").alias("y"))
    assert [r["y"] for r in df.collect()] == [1.0, None, 42.0, None]


def test_title_case_like_python(spark):
    names = ["mr-mime", "farfetch'd", "nidoran-f", "porygon2", "élan vital", "ho-oh", "small ring"]
    df = spark.createDataFrame([(n,) for n in names], "x string").select(fc.title_case("x").alias("y"))
    assert [r["y"] for r in df.collect()] == [n.title() for n in names]


def test_url_helpers(spark):
    rows = [("http://h:80/x",), ("item?id=1",), ("https://user@site.org/a?b=1",), ("http://[bad",)]
    df = spark.createDataFrame(rows, "u string")
    out = df.select(fc.absolute_url("u").alias("a"), fc.url_authority("u").alias("h")).collect()
    assert out[0]["h"] == "h:80"
    assert out[1]["a"] == "https://news.ycombinator.com/item?id=1"
    assert out[1]["h"] == "news.ycombinator.com"
    assert out[2]["h"] == "user@site.org"
    assert out[3]["h"] is None


def test_leading_count(spark):
    rows = [("12\xa0comments",), ("3 comments",), ("discuss",), ("comment",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(fc.leading_count("t").alias("n"))
    assert [r["n"] for r in df.collect()] == [12, 3, 0, 0, 0]


def test_private_ip(spark):
    rows = [("10.1.2.3",), ("172.16.0.1",), ("172.32.0.1",), ("192.168.1.1",), ("8.8.8.8",), ("10.1.2",),
            ("a.b.c.d",), (None,)]
    df = spark.createDataFrame(rows, "ip string").select(fc.is_private_ipv4("ip").alias("p"))
    assert [r["p"] for r in df.collect()] == [True, True, False, True, False, False, False, False]


def test_protocol_family(spark):
    rows = [("tcp",), ("6",), ("UDP",), ("1",), ("https",), ("gre",), (None,)]
    df = spark.createDataFrame(rows, "p string").select(fc.protocol_family("p").alias("f"))
    assert [r["f"] for r in df.collect()] == ["tcp", "tcp", "udp", "icmp", "http", "other", "other"]


def test_row_argmax_and_sum(spark):
    rows = [(None, None, None), (1.0, 1.0, 0.0), (-1.0, -2.0, -3.0), (0.5, None, 2.0)]
    df = spark.createDataFrame(rows, "na double, eu double, jp double")
    out = df.select(fc.row_argmax(["na", "eu", "jp"], ["na", "eu", "jp"]).alias("m"),
                    fc.row_sum(["na", "eu", "jp"]).alias("s")).collect()
    # all null -> zeros -> first wins; tie -> first; all negative -> null counts as 0 is not used here
    assert [r["m"] for r in out] == ["na", "na", "na", "jp"]
    assert [r["s"] for r in out] == [0.0, 2.0, -6.0, 2.5]


def test_range_position_division_rules(spark):
    rows = [(5.0, 0.0, 10.0), (5.0, 5.0, 5.0), (6.0, 5.0, 5.0), (4.0, 5.0, 5.0), (1.0, None, None)]
    df = spark.createDataFrame(rows, "x double, lo double, hi double")
    got = [r["p"] for r in df.select(fc.range_position("x", "lo", "hi").alias("p")).collect()]
    assert got[0] == 50.0 and got[1] == 50.0 and got[4] == 50.0
    assert got[2] == math.inf and got[3] == -math.inf


def test_deviation_and_cv(spark):
    rows = [(110.0, 100.0, 5.0), (1.0, 0.0, 1.0), (1.0, -2.0, 1.0), (1.0, 2.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, s double")
    out = df.select(fc.deviation_pct("a", "b").alias("d"), fc.coef_variation("s", "b").alias("c")).collect()
    assert [round(r["d"], 9) for r in out] == [10.0, 0.0, 0.0, -50.0]
    assert [r["c"] for r in out] == [5.0, 0.0, 0.0, None]


def test_whole_days_floor(spark):
    rows = [("2025-01-01 00:00:00", "2024-12-31 12:00:00"), ("2025-01-01 00:00:00", "2025-01-01 12:00:00"),
            ("2024-03-01 00:00:00", "2024-02-28 00:00:00")]
    df = spark.createDataFrame(rows, "a string, b string").select(
        fc.whole_days_between(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")).alias("d"))
    assert [r["d"] for r in df.collect()] == [0, -1, 2]


def test_decade_and_dates(spark):
    rows = [(1999.0,), (2000.0,), (None,)]
    df = spark.createDataFrame(rows, "y double").select(fc.decade("y").alias("d"))
    assert [r["d"] for r in df.collect()] == [1990, 2000, None]
    d = spark.createDataFrame([("2/29/2024",), ("bad",)], "t string").select(
        fc.parse_timestamp("t", "M/d/yyyy").alias("ts"))
    parts = d.select(*[c.alias(k) for k, c in fc.date_parts("ts").items()]).collect()
    assert (parts[0]["year"], parts[0]["month"], parts[0]["day_of_week"]) == (2024, 2, "Thursday")
    assert parts[1]["year"] is None


def test_float_div_ieee_rules(spark):
    rows = [(1.0, 0.0), (-2.0, 0.0), (0.0, 0.0), (None, 0.0), (3.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double").select(fc.float_div("a", "b").alias("q"))
    got = [r["q"] for r in df.collect()]
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2]) and got[3] is None and got[4] == 1.5


def test_float_div_null_denominator(spark):
    df = spark.createDataFrame([(1.0, None), (0.0, None)], "a double, b double")
    assert [r["q"] for r in df.select(fc.float_div("a", "b").alias("q")).collect()] == [None, None]


def test_cluster_conf_sizing():
    from rillet.session import cluster_conf
    big = cluster_conf(100 * 10**12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) % 8000 == 0
    assert 100 * 10**12 / int(big["spark.sql.shuffle.partitions"]) <= 256 << 20
    small = cluster_conf(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
