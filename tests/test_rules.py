"""Bins and rule chains: edges, NULL/NaN, ties."""

from pyspark.sql import functions as F

from rillet.functions.rules import bucketize, classify, onehot_decode, score, tri_state


def test_bucketize_left_open_right_closed(spark):
    vals = [None, float("nan"), 0.0, 18.0, 18.5, 100.0, 101.0, -1.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = [r["b"] for r in df.select(bucketize("x", [0, 18, 30, 45, 60, 100],
                                               ["Under 18", "18-30", "31-45", "46-60", "Over 60"]).alias("b")).collect()]
    assert out == [None, None, None, "Under 18", "18-30", "Over 60", None, None]


def test_bucketize_open_top(spark):
    df = spark.createDataFrame([(0.0,), (1e9,), (float("nan"),)], "x double")
    out = [r["b"] for r in df.select(bucketize("x", [0, 50, float("inf")], ["a", "b"]).alias("b")).collect()]
    assert out == [None, "b", None]


def test_classify_null_falls_to_default(spark):
    df = spark.createDataFrame([(None,), (6.0,), (2.0,), (-3.0,)], "p double")
    p = F.col("p")
    out = [r["c"] for r in df.select(classify([(p > 2, "strong_gain"), (p > 0, "gain"), (p < -2, "strong_loss")],
                                              "loss").alias("c")).collect()]
    assert out == ["loss", "strong_gain", "gain", "strong_loss"]


def test_score_clamps(spark):
    df = spark.createDataFrame([(True, True), (False, False), (None, True)], "a boolean, b boolean")
    out = [r["s"] for r in df.select(score([(F.col("a"), -80), (F.col("b"), -40)], base=100, lo=0, hi=100).alias("s"))
           .collect()]
    assert out == [0.0, 100.0, 60.0]


def test_onehot_last_wins(spark):
    df = spark.createDataFrame([(1, 1, 0), (0, 0, 0), (1, 0, 1)], "t int, u int, i int")
    out = [r["p"] for r in df.select(onehot_decode(["t", "u", "i"], ["tcp", "udp", "icmp"]).alias("p")).collect()]
    assert out == ["udp", "unknown", "icmp"]


def test_tri_state(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "s boolean")
    assert [r["o"] for r in df.select(tri_state("s").alias("o")).collect()] == ["Success", "Failure", "Unknown"]
