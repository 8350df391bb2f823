"""Property tests: Spark expressions against the pandas / numpy / Python
behaviour they stand in for, on generated batches of values."""

import math

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from rillet.functions import columns as fc
from rillet.functions.rules import bucketize

FINITE = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)
SETTINGS = settings(max_examples=15, deadline=None)


@SETTINGS
@given(st.lists(st.one_of(FINITE, st.none(), st.just(float("nan"))), min_size=1, max_size=40))
def test_bucketize_equals_pd_cut(spark, xs):
    edges, labels = [0, 18, 30, 45, 60, 100], ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r["b"] for r in df.select(bucketize("x", edges, labels).alias("b")).collect()]
    want = pd.cut(pd.Series(xs, dtype="float64"), bins=edges, labels=labels)
    assert got == [None if pd.isna(w) else str(w) for w in want]


@SETTINGS
@given(st.lists(FINITE, min_size=1, max_size=40), st.integers(min_value=0, max_value=4))
def test_round_equals_numpy(spark, xs, places):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r["y"] for r in df.select(fc.round_half_even("x", places).alias("y")).collect()]
    assert got == [float(np.round(x, places)) for x in xs]


@SETTINGS
@given(st.lists(st.text(alphabet="abcXYZé-' 12_", min_size=0, max_size=12), min_size=1, max_size=20))
def test_title_case_equals_python(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "x string")
    got = [r["y"] for r in df.select(fc.title_case("x").alias("y")).collect()]
    assert got == [n.title() for n in names]


@SETTINGS
@given(st.lists(FINITE, min_size=1, max_size=60), st.sampled_from([0.0, 0.15, 0.25, 0.5, 0.75, 0.85, 1.0]))
def test_exact_quantile_equals_numpy(spark, xs, q):
    from rillet.operators.stats import exact_quantiles
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = exact_quantiles(df, "x", [q], ["v"]).first()["v"]
    assert got == float(np.quantile(xs, q)) or math.isclose(got, float(np.quantile(xs, q)), rel_tol=1e-15)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(FINITE, st.none()), st.one_of(FINITE, st.none()),
                          st.one_of(FINITE, st.none())), min_size=1, max_size=20))
def test_row_argmax_equals_idxmax(spark, rows):
    df = spark.createDataFrame(rows, "na double, eu double, jp double")
    got = [r["m"] for r in df.select(fc.row_argmax(["na", "eu", "jp"]).alias("m")).collect()]
    pdf = pd.DataFrame(rows, columns=["na", "eu", "jp"]).astype("float64").fillna(0)
    assert got == list(pdf.idxmax(axis=1))
