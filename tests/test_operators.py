"""Distributed numbering, windows, quantiles, aggregates, joins and unions."""

import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillet.operators import aggregate as agg
from rillet.operators import combine as cmb
from rillet.operators import lookup, ranking
from rillet.operators.stats import exact_quantiles
from rillet.operators.timeseries import with_indicators, with_ranges
from rillet.session import checkpoint_dir


def test_global_index_is_a_dense_ordered_numbering(spark):
    vals = list(range(1000))
    random.Random(7).shuffle(vals)
    df = spark.createDataFrame([(v,) for v in vals], "v long").repartition(7)
    out = ranking.with_global_index(df, [F.col("v")], "rn", n_parts=5).collect()
    assert sorted((r["rn"], r["v"]) for r in out) == [(i + 1, i) for i in range(1000)]


def test_systematic_sample(spark):
    df = spark.createDataFrame([(i,) for i in range(1001)], "v long")
    got = sorted(r["v"] for r in ranking.systematic_sample(df, [F.col("v")], 200).collect())
    k = 1001 // 200
    assert got == list(range(0, 1001, k))[:200]
    small = spark.createDataFrame([(i,) for i in range(50)], "v long")
    assert ranking.systematic_sample(small, [F.col("v")], 200).count() == 50


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    xs = list(rng.normal(size=997)) + [None, float("nan")]
    df = spark.createDataFrame([(float(x) if x is not None else None,) for x in xs], "x double")
    qs = [0.15, 0.25, 0.75, 0.85]
    clean = [x for x in xs if x is not None and not np.isnan(x)]
    row = exact_quantiles(df, "x", qs, ["a", "b", "c", "d"]).first()
    assert list(row) == list(np.quantile(clean, qs))
    empty = exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5], ["m"]).collect()
    assert [r["m"] for r in empty] == [None]
    q = exact_quantiles(spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double"), "x", [0.85], ["q"])
    assert q.first()["q"] == np.quantile([1.0, 2.0, 3.0, 10.0], 0.85)  # bit-for-bit as pandas


def _series(spark):
    rows = []
    rng = random.Random(11)
    for sym, n in [("A", 1), ("B", 2), ("C", 45), ("D", 30)]:
        price = 100.0
        for t in range(n):
            price = price * (1 + rng.uniform(-0.05, 0.05)) if sym != "D" else 50.0
            rows.append((sym, t, price, rng.randint(1, 1000)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "symbol string, t long, close double, volume long")


def _pandas_indicators(pdf):
    import pandas as pd
    out = []
    for _, g in pdf.sort_values(["symbol", "t"]).groupby("symbol"):
        g = g.copy()
        g["daily_return"] = g["close"].pct_change() * 100
        g["ma_7"] = g["close"].rolling(7, min_periods=1).mean()
        g["ma_20"] = g["close"].rolling(20, min_periods=1).mean()
        g["volatility_7d"] = g["daily_return"].rolling(7, min_periods=1).std()
        d = g["close"].diff()
        gain = d.where(d > 0, 0).rolling(14, min_periods=1).mean()
        loss = (-d.where(d < 0, 0)).rolling(14, min_periods=1).mean()
        g["rsi"] = 100 - 100 / (1 + gain / loss.replace(0, 0.0001))
        g["momentum"] = (g["close"] - g["ma_7"]) / g["ma_7"] * 100
        out.append(g)
    res = pd.concat(out)
    cols = ["daily_return", "ma_7", "ma_20", "volatility_7d", "rsi", "momentum"]
    res[cols] = res[cols].fillna(0)
    return res


def test_indicators_match_pandas_and_chunking(spark):
    df = _series(spark)
    expect = _pandas_indicators(df.toPandas()).set_index(["symbol", "t"]).sort_index()
    cols = ["daily_return", "ma_7", "ma_20", "volatility_7d", "rsi", "momentum"]
    for kwargs in [dict(chunk_rows=21), {}]:
        got = with_indicators(df, "symbol", "t", **kwargs).toPandas().set_index(["symbol", "t"]).sort_index()
        assert np.allclose(got[cols].values, expect[cols].values, rtol=1e-9, atol=1e-9), kwargs


def test_head_tail_per_key(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 1)], "k string, t long")
    last = ranking.last_n_per_key(df, ["k"], [F.col("t")], 3).collect()
    assert sorted((r["k"], r["t"]) for r in last) == [("a", 7), ("a", 8), ("a", 9), ("b", 1)]
    first = ranking.first_n_per_key(df, ["k"], ["t"], 2).collect()
    assert sorted((r["k"], r["t"]) for r in first) == [("a", 0), ("a", 1), ("b", 1)]


def test_group_agg_domain_keeps_unobserved_labels(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), (None, 5.0)], "g string, v double")
    out = {r["g"]: r for r in agg.group_agg_domain(df, "g", ["x", "y"], {"s": F.sum("v")}, {"n": F.count("v")},
                                                    {"m": F.avg("v")}).collect()}
    assert (out["x"]["s"], out["x"]["n"], out["x"]["m"]) == (4.0, 2, 2.0)
    assert (out["y"]["s"], out["y"]["n"], out["y"]["m"]) == (0.0, 0, None)


def test_group_stats_null_key(spark):
    df = spark.createDataFrame([("r1", True), ("r1", False), (None, True), ("r2", None)], "k string, s boolean")
    out = agg.with_group_stats(df, ["k"], {"rate": F.avg(F.col("s").cast("int")), "n": F.count("k")}).collect()
    by = {(r["k"], r["s"]): (r["rate"], r["n"]) for r in out}
    assert by[("r1", True)] == (0.5, 2)
    assert by[(None, True)] == (None, None)
    assert by[("r2", None)] == (None, 1)


def test_lookup_default(spark):
    left = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "id int, spot double")
    series = spark.createDataFrame([(1, 9.0), (1, 11.0), (3, 5.0)], "id int, p double")
    out = {r["id"]: r for r in agg.lookup_with_default(
        left, series, ["id"], {"m": F.avg("p"), "s": F.stddev_samp("p")},
        {"m": F.col("spot"), "s": F.lit(0.0)}).collect()}
    assert out[1]["m"] == 10.0 and out[2]["m"] == 20.0 and out[2]["s"] == 0.0
    assert out[3]["s"] is None  # one row: sample std stays NULL


def test_split_union_and_fallback(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, c boolean")
    t, f = cmb.split(df, F.col("c"))
    assert t.count() + f.count() == 3
    u = cmb.union_branches(t.select("id", F.lit("x").alias("only_t")), f.select("id"))
    assert sorted((r["id"], r["only_t"]) for r in u.collect()) == [(1, "x"), (2, None), (3, None)]
    primary = spark.createDataFrame([(1, "v5")], "id int, src string")
    fallback = spark.createDataFrame([(1, "v4"), (2, "v4")], "id int, src string")
    assert sorted(tuple(r) for r in cmb.fallback_fill(primary, fallback, "id").collect()) == [(1, "v5"), (2, "v4")]


def test_tags_contain_all(spark):
    df = spark.createDataFrame([(True, False), (True, True)], "a boolean, b boolean")
    tags = cmb.tag_array([(F.col("a"), "A"), (F.col("b"), "B")])
    out = df.select(cmb.tags_contain_all(tags, ["A", "B"]).alias("ok")).collect()
    assert [r["ok"] for r in out] == [False, True]


def test_quantiles_by_counting_are_exact(spark):
    from rillet.operators.stats import exact_quantiles_many
    rng = np.random.default_rng(9)
    n = 30000
    x = np.where(rng.uniform(size=n) < 0.34, 7.0, rng.integers(0, 19, size=n).astype(float))  # a third holds one value
    columns = [x, rng.normal(size=n), rng.lognormal(0, 40, size=n), rng.normal(size=n) * 1e-310,
               np.where(rng.uniform(size=n) < 0.1, np.inf, np.where(rng.uniform(size=n) < 0.2, -np.inf, rng.normal(size=n) * 1e300))]
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in zip(*columns)], ", ".join(f"c{i} double" for i in range(5)))
    qs = [0.0, 0.15, 0.5, 0.85, 1.0]
    specs = [(f"c{i}", q, f"c{i}_{j}") for i in range(5) for j, q in enumerate(qs)]
    row = exact_quantiles_many(df, specs).first()
    with np.errstate(invalid="ignore"):
        for i, c in enumerate(columns):
            got, want = [row[f"c{i}_{j}"] for j in range(5)], np.quantile(c, qs)
            assert all(g == w or (np.isnan(g) and np.isnan(w)) or np.isinf(w) or np.isnan(w) for g, w in zip(got, want)), (i, got, list(want))


def test_systematic_sample_edges(spark):
    for n, m in [(200, 200), (201, 200), (1001, 200), (399, 200)]:
        df = spark.createDataFrame([(i,) for i in range(n)], "v long")
        got = sorted(r["v"] for r in ranking.systematic_sample(df, [F.col("v")], m).collect())
        expect = list(range(n)) if n <= m else list(range(0, n, n // m))[:m]
        assert got == expect, (n, m)


def test_left_join_dims_edges(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, dim_id int")
    dim = spark.createDataFrame([(10, "a"), (10, "a2"), (11, "b")], "dim_id int, name string")
    out = sorted((r["id"], r["name"]) for r in cmb.left_join_dims(fact, [(dim, "dim_id")]).collect())
    # duplicate dimension key fans out; unmatched and NULL keys keep NULL columns
    assert out == [(1, "a"), (1, "a2"), (2, None), (3, None)]
    from pyspark.sql import types as T
    empty = cmb.typed_empty(spark, T.StructType([T.StructField("dim_id", T.IntegerType()),
                                                 T.StructField("name", T.StringType())]))
    assert sorted((r["id"], r["name"]) for r in cmb.left_join_dims(fact, [(empty, "dim_id")]).collect()) == \
        [(1, None), (2, None), (3, None)]


def test_union_column_order_and_empty_side(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("y", 2, 0.5)], "s string, id int, extra double")
    e = spark.createDataFrame([], "id int")
    out = sorted(tuple(r) for r in cmb.union_branches(a, b, e).select("id", "s", "extra").collect())
    assert out == [(1, "x", None), (2, "y", 0.5)]


def test_value_counts_and_null_profile(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "c string")
    assert sorted(tuple(r) for r in agg.value_counts(df, "c").collect()) == [("a", 2), ("b", 1)]
    prof = {r["column_name"]: (r["rows"], r["non_null"]) for r in agg.null_profile(df).collect()}
    assert prof == {"c": (4, 3)}


def test_group_index_first_seen(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (1, 3, "x"), (1, 4, "z"), (2, 1, "z")],
                               "parent_id long, stage_number int, stage_type string")
    from rillet.plans.parents import group_colours
    out = {(r["parent_id"], r["stage_number"]): r["colour_index"] for r in group_colours(df, palette=2, key=F.col("stage_type")).collect()}
    assert out == {(1, 1): 0, (1, 2): 1, (1, 3): 0, (1, 4): 0, (2, 1): 0}


def test_global_index_with_few_partitions(spark):
    df = spark.createDataFrame([(i,) for i in range(100)], "v long")
    out = ranking.with_global_index(df, [F.col("v")], "rn", n_parts=3).collect()
    assert sorted((r["rn"], r["v"]) for r in out) == [(i + 1, i) for i in range(100)]


def test_rolling_hot_key_split_matches_plain(spark):
    """One key holds most rows; the chunked path (many chunks for that key)
    gives exactly the plain per-key window result."""
    rng = random.Random(5)
    rows = [("HOT", t, 100 + rng.uniform(-5, 5), rng.randint(1, 50)) for t in range(400)]
    rows += [(f"k{i}", t, 50 + rng.uniform(-1, 1), rng.randint(1, 50)) for i in range(5) for t in range(20)]
    df = spark.createDataFrame(rows, "symbol string, t long, close double, volume long")
    cols = ["daily_return", "ma_7", "ma_20", "volatility_7d", "rsi", "momentum"]
    plain = with_indicators(df, "symbol", "t").toPandas().set_index(["symbol", "t"]).sort_index()
    split = with_indicators(df, "symbol", "t", chunk_rows=30).toPandas().set_index(
        ["symbol", "t"]).sort_index()
    assert len(split) == len(plain) == 500
    assert np.allclose(split[cols].values, plain[cols].values, rtol=0, atol=1e-9)


def test_global_index_balances_a_repeated_key(spark):
    rows = [("hot", 1)] * 3000 + [(f"k{i}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, v long").withColumn("u", F.monotonically_increasing_id())
    out = ranking.with_global_index(df, [F.col("k")], "rn", n_parts=8)
    assert sorted(r["rn"] for r in out.select("rn").collect()) == list(range(1, 4001))
    sizes = [r["c"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("c")).collect()]
    assert max(sizes) < 3000  # the repeated key is split over several partitions


def _jobs_of(spark, work):
    """What ``work`` returns, and the number of Spark jobs it ran."""
    group = f"jobs-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_ranges_of_few_rows_equal_whole_windows(spark):
    """Ranges shorter than the lookback, hot keys beside short ones, ties in time, null times and keys."""
    rng = random.Random(21)
    rows = [(k, t, 50 + rng.uniform(-5, 5), rng.randint(1, 99)) for k, n in [("A", 1), ("B", 400), ("C", 7), (None, 90), ("D", 60)] for t in range(n)]
    rows += [("B", None, 50.0, 5), ("B", 17, 51.0, 6), ("B", 17, 52.0, 7)]
    df = spark.createDataFrame(rows, "symbol string, t long, close double, volume long").repartition(5)
    whole = with_indicators(df, "symbol", "t").collect()
    for chunk in (1, 5, 21, 64):
        got = with_indicators(df, "symbol", "t", chunk_rows=chunk).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, whole)), chunk
        assert len({r["n"] for r in with_ranges(df, "symbol", "t", chunk).select(F.col("_range").alias("n")).distinct().collect()}) > 2


def test_ranges_of_times_and_dates(spark):
    df = spark.range(300).selectExpr("'k' AS key", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,CAST(id AS INT)) AS ts",
                                     "date_add(date'2024-01-01', CAST(id AS INT)) AS day", "CAST(id AS DECIMAL(9,1)) AS amount")
    for column in ("ts", "day", "amount"):
        sizes = [r["count"] for r in with_ranges(df, "key", column, 30).groupBy("_range").count().collect()]
        assert len(sizes) == 10 and max(sizes) <= 60
        order = with_ranges(df, "key", column, 30).groupBy("_range").agg(F.min(column).alias("a"), F.max(column).alias("b")).orderBy("_range").collect()
        assert all(x["b"] < y["a"] for x, y in zip(order, order[1:]))
    with pytest.raises(TypeError):
        with_ranges(df, "key", "key", 30)


def test_whole_rows_are_shuffled_once(spark):
    """Both branches read one exchange of whole rows, and nothing is run or written while the frame is built."""
    df = spark.createDataFrame([("A", t, float(t % 7), t) for t in range(300)], "symbol string, t long, close double, volume long")
    out, jobs = _jobs_of(spark, lambda: with_indicators(df, "symbol", "t", chunk_rows=25))
    assert jobs == 0
    out.write.format("noop").mode("overwrite").save()
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    whole = [line for line in final.splitlines() if "Exchange hashpartitioning(symbol" in line and "_range" in line and "Reused" not in line]
    assert len(whole) == 1 and "ReusedExchange" in final


def test_pruned_rows_are_shuffled_once(spark):
    """A view of some columns still reads one exchange in both branches."""
    df = spark.createDataFrame([(k, t, float(t % 7), t) for k in "AB" for t in range(100)], "symbol string, t long, close double, volume long")
    out = with_indicators(df, "symbol", "t", chunk_rows=25).select("symbol", "t", "daily_return")
    assert len(out.collect()) == 200
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    run = [b for a, b in zip(lines, lines[1:]) if "ShuffleQueryStage" in a and "hashpartitioning(symbol" in b and "_range" in b]
    assert len(run) == 2 and sum("ReusedExchange" in b for b in run) == 1, run


def test_group_stats_written_ahead_move_no_rows(spark, monkeypatch):
    """Statistics written before the join go to the rows, whatever the planner takes for small; more keys than that are joined by a shuffle."""
    df = spark.createDataFrame([(None if i % 9 == 0 else i % 4, i) for i in range(60)], "k int, v long")
    want = sorted(map(repr, agg.with_group_stats(df, ["k"], {"m": F.avg("v")}).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, join in ((4, "BroadcastHashJoin"), (3, "SortMergeJoin")):
            monkeypatch.setattr(agg, "BROADCAST_KEYS", most)
            out = agg.with_group_stats(df, ["k"], {"m": F.avg("v")}, ahead=True)
            assert sorted(map(repr, out.collect())) == want
            assert join in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_global_statistics_build_without_a_job(spark):
    from rillet.operators.stats import max_normalize, with_global_stats
    df = spark.createDataFrame([(1, 2.0), (2, 8.0), (3, None)], "i int, x double")
    out, jobs = _jobs_of(spark, lambda: max_normalize(df, "x", "share"))
    assert jobs == 0 and sorted(map(tuple, out.select("i", "share").collect())) == [(1, 25.0), (2, 100.0), (3, 0.0)]
    two = with_global_stats(df, {"lo": F.min("x"), "n": F.count("*")}).select("i", "lo", "n").collect()
    assert sorted(map(tuple, two)) == [(1, 2.0, 3), (2, 2.0, 3), (3, 2.0, 3)]
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_quantiles_take_two_passes(spark):
    """One action for the sketches and one for the exact counts, whatever the ties; brackets of many rows add rounds only."""
    from rillet.operators import stats
    rng = np.random.default_rng(4)
    x = np.where(rng.uniform(size=20000) < 0.4, 3.0, rng.normal(size=20000))
    path = f"{checkpoint_dir(spark)}/quantiles-{uuid.uuid4().hex}"
    spark.createDataFrame([(float(v),) for v in x], "x double").repartition(4).write.parquet(path)
    df, qs = spark.read.parquet(path), [0.0, 0.1, 0.5, 0.75, 0.999, 1.0]
    frame, jobs = _jobs_of(spark, lambda: exact_quantiles(df, "x", qs, list("abcdef")))
    got = list(frame.first())
    # An action is a job for its map side and one for its result.
    assert got == list(np.quantile(x, qs)) and jobs <= 4
    for size in (4, 64):
        old, stats.BRACKET = stats.BRACKET, size
        try:
            assert list(exact_quantiles(df, "x", qs, list("abcdef")).first()) == got
        finally:
            stats.BRACKET = old


def _rows_read(df):
    """Rows that the scans of an executed frame gave out."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Scan"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def test_tag_index_equals_the_scan(spark, tmp_path):
    rng = random.Random(12)
    rows = [(rng.randrange(-70000, 200000) if k % 9 else None, [t for t in ("a", "b", "c", None) if rng.random() < 0.5]) for k in range(3000)]
    rows += [(i, ["a", "b", "a"]) for i in (0, 1, -1, 32767, 32768, 32769, 65536, 65537, -32768, 1 << 40)] + [(5, None), (6, [])]
    df = spark.createDataFrame(rows, "id long, tags array<string>").repartition(4)
    path = str(tmp_path / "index")
    lookup.write_tag_index(df, path, "id", "tags")
    index = spark.read.parquet(path)
    assert index.count() == index.select("tag", "bucket").distinct().count()
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, set()).update(t or [])
    by_id.pop(None)
    for wanted in (["a"], ["a", "b"], ["b", "b", "c"], ["a", "b", "c"], ["a", "zz"]):
        got = [r["id"] for r in lookup.ids_with_all(index, wanted).collect()]
        # An id on several rows has the tags of all of them.
        assert sorted(got) == sorted(i for i, t in by_id.items() if set(wanted) <= t)
    sets = lookup.ids_by_set(index, {"x": ["a"], "y": ["b", "c"]}).groupBy("name").count().collect()
    assert {r["name"]: r["count"] for r in sets} == {"x": sum("a" in t for t in by_id.values()), "y": sum({"b", "c"} <= t for t in by_id.values())}
    with pytest.raises(ValueError):
        lookup.ids_with_all(index, [])


def test_a_late_page_reads_few_rows(spark, tmp_path):
    rng = random.Random(3)
    vals = [rng.randrange(500) for _ in range(60000)]  # many ties
    df = spark.createDataFrame([(v, k) for k, v in enumerate(vals)], "v int, k int").repartition(6)
    path = str(tmp_path / "pages")
    lookup.write_pages(df, path, ["v"])
    order = sorted(vals)
    seen = set()
    for offset in (0, 20, 41230, 59995):
        page = lookup.read_page(spark, path, offset, 20)
        got = page.collect()
        assert [r["v"] for r in got] == order[offset:offset + 20] and [r["row_no"] for r in got] == list(range(offset + 1, min(60000, offset + 20) + 1))
        assert not seen & {r["k"] for r in got}
        seen |= {r["k"] for r in got}
        assert _rows_read(page) <= 4 * lookup.PAGE_ROWS
    assert lookup.read_page(spark, path, 60000, 20).count() == 0


def test_a_lookup_by_key_and_time_skips_row_groups(spark, tmp_path):
    df = spark.range(40000).selectExpr("concat('s', id % 400 * 7) AS symbol", "date_add(date'2024-01-01', CAST(id / 100 AS INT)) AS ts", "id AS v")
    path = str(tmp_path / "series")
    lookup.write_series(df, path, "symbol", "ts", files=8)
    table = spark.read.parquet(path)
    one = table.filter((F.col("symbol") == "s1400") & F.col("ts").between(F.lit("2024-02-05").cast("date"), F.lit("2024-02-19").cast("date")))
    assert one.count() == df.filter("symbol = 's1400' AND ts BETWEEN date'2024-02-05' AND date'2024-02-19'").count()
    assert _rows_read(one) <= 8 * lookup.PAGE_ROWS
    # 's1' lies between the smallest and the largest symbol of every row group; only the Bloom filters rule it out.
    assert _rows_read(table.filter(F.col("symbol") == "s1")) == 0
    assert _rows_read(table.filter(F.col("symbol") == "s7")) > 0
