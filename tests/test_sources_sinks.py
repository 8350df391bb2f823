"""Sources (CSV, JSON reshaping, HTML) and sinks (files, JDBC, JSON export)."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillet import sinks
from rillet.session import checkpoint_dir
from rillet.sources import files as fs
from rillet.sources import html as htm
from rillet.sources import reshape as rs


def scratch(spark, name):
    return f"{checkpoint_dir(spark)}/tests/{name}-{uuid.uuid4().hex}"


def test_csv_na_tokens_and_glob(spark, tmp_path):
    p = tmp_path / "in"
    p.mkdir()
    (p / "a.csv").write_text("name,price\nx,1.5\ny,n/a\nz,\n")
    (p / "notes.txt").write_text("ignored")
    df = fs.read_csv(spark, str(p), "name string, price double")
    assert sorted((r["name"], r["price"]) for r in df.collect()) == [("x", 1.5), ("y", None), ("z", None)]


def test_csv_quotes_newlines_blanks_and_types(spark, tmp_path):
    p = tmp_path / "in"
    p.mkdir()
    (p / "a.csv").write_text('n,text,note,flag,big\n1,"x ""q"", y",u,true,9999999999\nN/A,"two\nlines", ,False,NA\n-3,NULL,"",,1\n')
    (p / "one.txt").write_text("n\n5\n")
    df = fs.read_csv(spark, str(p))
    assert dict(df.dtypes) == {"n": "bigint", "text": "string", "note": "string", "flag": "boolean", "big": "bigint"}
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted(
        [(1, 'x "q", y', "u", True, 9999999999), (None, "two\nlines", " ", False, None), (-3, None, None, None, 1)], key=str)
    typed = fs.read_csv(spark, str(p), "n double, text string, note string, flag boolean, big string").collect()
    assert {r["n"] for r in typed} == {1.0, None, -3.0}
    assert [tuple(r) for r in fs.read_csv(spark, str(p / "one.txt")).collect()] == [(5,)]
    (tmp_path / "empty").mkdir()
    for missing in (p / "gone.csv", tmp_path / "empty"):
        with pytest.raises(FileNotFoundError):
            fs.read_csv(spark, str(missing))


def test_corrupt_records_are_returned(spark):
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, "{broken"), (3, None)], "id int, j string")
    assert [tuple(r) for r in rs.corrupt_records(df, "j", "struct<a: int>", ["id"]).collect()] == [(2, "{broken")]
    arrays = spark.createDataFrame([(["x", "y"],), (None,)], "a array<string>")
    assert [r[0] for r in arrays.select(rs.arrays_as_text({"t": "a"})["t"]).collect()] == ['["x","y"]', "[]"]


def test_zip_with_default_follows_main_list(spark):
    df = spark.createDataFrame([(1, [[1.0, 10.0], [2.0, 20.0], [3.0, 30.0]], [[1.0, 5.0]]),
                                (2, [[1.0, 1.0]], [[1.0, 7.0], [2.0, 8.0]])],
                               "id int, prices array<array<double>>, vols array<array<double>>")
    out = sorted(tuple(r) for r in rs.zip_with_default(df, "prices", "vols", ["id"]).collect())
    assert out == [(1, 0, 1.0, 10.0, 5.0), (1, 1, 2.0, 20.0, 0.0), (1, 2, 3.0, 30.0, 0.0), (2, 0, 1.0, 1.0, 7.0)]


def test_keyed_object_and_corrupt_json(spark):
    df = spark.createDataFrame([('{"btc": {"usd": 1.0}, "eth": {"usd": 2.0}}',), ("{broken",)], "j string")
    schema = T.StructType([T.StructField("usd", T.DoubleType())])
    out = sorted(tuple(r) for r in rs.keyed_object_to_rows(df, "j", schema, wanted=["eth"]).collect())
    assert out == [("eth", 2.0)]


def test_positional_defaults(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "a array<int>")
    out = [tuple(r) for r in df.select(rs.positional("a", 0, default=0), rs.positional("a", 1)).collect()]
    assert out == [(1, 2), (0, None), (0, None)]


def test_html_blocks(spark):
    html = '<ul><li><a href="/a">A</a></li><li><a href="item?id=2">B</a></li></ul><h1> T </h1>'
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "page_id long, html string")
    out = htm.extract_blocks(df, "html", htm.LINK_BLOCK, {"href": 1, "text": 2}, ["page_id"]).collect()
    assert [(r["page_id"], r["pos"], r["href"], r["text"]) for r in out] == [(1, 0, "/a", "A"), (1, 1, "item?id=2", "B")]
    t = df.select(htm.plain_text(htm.capture("html", r"<h1>(.*?)</h1>")).alias("t")).collect()
    assert [r["t"] for r in t] == ["T", None]


STORIES = """<html><table>
<tr class='athing submission' id='11'><td><span class="titleline"><a href="http://x.org/a?b=1">A <b>bold</b> &amp; &quot;q&quot;</a></span></td></tr>
<tr><td class="subtext"><span class="score">153 points</span> by <a class="hnuser" href="user?id=u">u</a>
 <span class="age"><a href="item?id=11">3 hours ago</a></span> | <a href="item?id=11">12&nbsp;comments</a></td></tr>
<tr class="spacer"></tr>
<tr class="athing" id="12"><td><span class="titleline"><a href="item?id=12">Ask</a></span></td></tr>
<tr><td class="subtext"><a href="item?id=12">discuss</a></td></tr>
<tr class="athing" id="13"><td><span class="titleline">no link</span></td></tr>
<tr><td class="subtext"><a href="x">1 comment</a></td></tr>
<tr class="athing" id="14"><td><span class="titleline"><a href="https://h:8080/p">No details</a></span></td></tr>
<tr><td>nothing</td></tr>
<tr class="athing" id="15"><td><span class="titleline"><a href="https://news.ycombinator.com/newest">No links</a></span></td></tr>
<tr><td class="subtext"><span class="score">7 points</span></td></tr>
<tr class="athing" id="16"><td><span class="titleline"><a>Bare</a></span></td></tr>
<tr><td class="subtext"><span class="score">many points</span><a href="x">hide</a></td></tr>
<tr class="athing" id="17"><td><span class="titleline"><a href="https://h:8080/p">Port</a></span></td></tr>
<tr><td class="subtext"><span class="score"></span><a href="x">many comments</a></td></tr>
</table></html>"""


def test_every_story_of_a_page(spark):
    from rillet.plans.pages import flow_posts
    pages = spark.createDataFrame([(3, STORIES), (4, "<p>no stories</p>"), (5, None)], "page_no long, html string")
    got = {r["story_id"]: r for r in flow_posts(pages).collect()}
    assert set(got) == {"11", "12", "17"}
    a, b, c = got["11"], got["12"], got["17"]
    assert (a["page_no"], a["title"], a["url"], a["points"], a["author"], a["age"], a["comments"]) == (
        3, 'A bold & "q"', "http://x.org/a?b=1", 153, "u", "3 hours ago", 12)
    assert (a["source"], a["is_external"], a["popularity"]) == ("x.org", True, "viral")
    assert (b["url"], b["points"], b["author"], b["age"], b["comments"], b["source"], b["is_external"], b["popularity"]) == (
        "https://news.ycombinator.com/item?id=12", 0, "unknown", "unknown", 0, "news.ycombinator.com", False, "new")
    assert (c["source"], c["points"], c["comments"], c["is_external"]) == ("h:8080", 0, 0, True)


def test_replace_files_checks_and_replaces(spark):
    path = scratch(spark, "replace")
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    assert sinks.replace_files(df, path, partition_by=["k"], sort_within=["id"]) == 10
    assert sinks.replace_files(df.limit(4), path) == 4
    assert spark.read.parquet(path).count() == 4


def test_jdbc_sink_in_process_derby(spark):
    url = f"jdbc:derby:memory:rillet{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(i, f"n{i}") for i in range(2500)], "id int, name string")
    assert sinks.replace_jdbc(df, url, "T_OUT", props, batch_size=1000) == 2500
    assert sinks.replace_jdbc(df.limit(3), url, "T_OUT", props) == 3


def test_export_shape_types(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(2, Decimal("1.50"), "2024-01-02 03:04:05"), (1, Decimal("2.25"), None)],
                               "id int, amount decimal(10,2), ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = sinks.export_shape(df, ["id"], 1).collect()
    assert [tuple(r) for r in out] == [(1, 2.25, None)]
    full = sinks.export_shape(df, ["id"], None).collect()
    assert full[1]["ts"] == "2024-01-02T03:04:05" and isinstance(full[1]["amount"], float)


def test_write_many_skips_empty_and_collects_failures(spark):
    written = []

    def writer(name, df):
        if name == "bad":
            raise ValueError("boom")
        written.append(name)
        return df.count()
    frames = {"a": spark.range(3), "empty": spark.range(0), "bad": spark.range(1)}
    with pytest.raises(RuntimeError, match="bad"):
        sinks.write_many(frames, writer)
    assert written == ["a"]


def test_fan_in_skips_missing(spark):
    a = spark.createDataFrame([(1,)], "x int")
    out = fs.fan_in({"north": a, "south": None, "east": a}, "region")
    assert sorted(r["region"] for r in out.collect()) == ["east", "north"]
    with pytest.raises(ValueError):
        fs.fan_in({"x": None})


def test_read_paths_tagged_skips_absent(spark):
    p = scratch(spark, "tagged")
    spark.range(2).write.parquet(p)
    out = fs.read_paths_tagged(spark, {"here": p, "gone": p + "-missing"}, tag="region")
    assert out.count() == 2 and {r["region"] for r in out.collect()} == {"here"}
    assert os.path.basename(p)


def test_arrays_to_rows_missing_and_short(spark):
    df = spark.createDataFrame([({"t": [1, 2], "v": [0.5, 1.5]},), ({"t": [3], "v": None},), (None,)],
                               "h struct<t: array<int>, v: array<double>>")
    out = sorted(tuple(r) for r in rs.arrays_to_rows(df, "h", ["t", "v"]).collect())
    assert out == [(1, 0.5), (2, 1.5), (3, None)]


def test_child_rows_filter(spark):
    docs = spark.createDataFrame([("p1", [(1, "a"), (2, "b")]), ("p2", [(3, "c")])],
                                 "pipeline_id string, stages array<struct<stage_id: int, stage_type: string>>")
    assert rs.child_rows(docs, "pipeline_id", "stages").count() == 3
    out = [tuple(r) for r in rs.child_rows(docs, "pipeline_id", "stages", "p2").collect()]
    assert out == [("p2", 3, "c")]


def test_jdbc_query_source(spark):
    url = f"jdbc:derby:memory:src{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(i, i % 3) for i in range(100)], "ID int, G int")
    sinks.replace_jdbc(df, url, "T_SRC", props)
    q = "SELECT G, COUNT(*) AS N FROM T_SRC GROUP BY G"
    out = sorted(tuple(r) for r in fs.read_jdbc_query(spark, url, q, props).collect())
    assert out == [(0, 34), (1, 33), (2, 33)]
    parts = fs.read_jdbc_query(spark, url, "SELECT ID, G FROM T_SRC", props, "ID", 0, 100, 4)
    assert parts.rdd.getNumPartitions() == 4 and parts.count() == 100


def test_processing_time_stamp(spark):
    df = sinks.with_processing_time(spark.range(2), as_of="2025-01-01 00:00:00")
    assert {str(r["processed_at"]) for r in df.collect()} == {"2025-01-01 00:00:00"}
    live = sinks.with_processing_time(spark.range(2)).collect()
    assert live[0]["processed_at"] is not None and live[0]["processed_at"] == live[1]["processed_at"]


def test_flows_run_on_landed_files(spark, tmp_path):
    from rillet.plans.landed import run_flow
    (tmp_path / "resorts.csv").write_text('Listing Id,Resort Name,Price,Reviews\n1,"Sea, Sun","US$1,234.50",12 reviews\n2,Hill,N/A,none yet\n')
    rows = {r["listing_id"]: r for r in run_flow(spark, "flow_listings", {"listings": f"csv:{tmp_path}/resorts.csv"}).collect()}
    assert rows[1]["name"] == "Sea, Sun" and rows[1]["price_usd"] == 1234.5 and rows[1]["review_count"] == 12.0
    assert rows[2]["price_usd"] is None and rows[2]["review_count"] is None
    (tmp_path / "pages").mkdir()
    for k in (1, 2):
        (tmp_path / "pages" / f"{k}.html").write_text(STORIES)
    posts = run_flow(spark, "flow_posts", {"pages": f"html:{tmp_path}/pages"}).collect()
    assert sorted((r["page_no"], r["story_id"]) for r in posts) == sorted((k, i) for k in (1, 2) for i in ("11", "12", "17"))
    (tmp_path / "e.json").write_text('{"id": 1, "stats": [{"base_stat": 50}], "species": {"url": "u/1"}}\n{"id": 2, broken\n')
    (tmp_path / "s.json").write_text('{"url": "u/1"}\n')
    got = run_flow(spark, "flow_legendary", {"entities": f"json:{tmp_path}/e.json", "species": f"json:{tmp_path}/s.json"}).collect()
    assert len(got) == 1 and (got[0]["name"], got[0]["generation"], got[0]["hp"], got[0]["weight"], got[0]["is_legendary"]) == ("Unknown", "unknown", 50, 0, False)
    assert got[0]["power_score"] == 50.0 and got[0]["type_primary"] == "normal"
    with pytest.raises(ValueError):
        run_flow(spark, "flow_posts", {})


def test_content_of_rows_ignores_order_and_sees_every_value(spark):
    rows = [(1, "a", 1.5, {"k": 1}), (1, "a", 1.5, {"k": 1}), (2, None, None, None), (3, "", 0.0, {})]
    schema = "i long, s string, d double, m map<string,int>"

    def of(data):
        df = spark.createDataFrame(data, schema)
        return tuple(df.repartition(3).agg(*sinks.content(df.schema)).first())
    base = of(rows)
    assert base == of(rows[::-1])
    for k, changed in ((0, (1, "b", 1.5, {"k": 1})), (0, (1, "a", 1.5, {"k": 2})), (2, (2, "", None, None)), (3, (3, None, 0.0, {})), (2, (2, None, 0.0, None))):
        other = list(rows)
        other[k] = changed
        assert of(other) != base
    assert of([]) == (0, 0) and of(rows[1:]) != base


def test_a_swapped_value_is_caught_and_the_old_data_stay(spark, tmp_path, monkeypatch):
    """Same count, one value exchanged between two rows behind the writer's back."""
    path = str(tmp_path / "t")
    sinks.replace_files(spark.range(3).selectExpr("id", "id * 2 AS v"), path)
    plain = sinks._verify

    def tampered(target, obs, schema, back, *rest):
        plain(target, obs, schema, back.withColumn("v", F.when(F.col("id") == 1, 40).when(F.col("id") == 2, 20).otherwise(F.col("v"))))
    monkeypatch.setattr(sinks, "_verify", tampered)
    with pytest.raises(sinks.ContentMismatch):
        sinks.replace_files(spark.range(3).selectExpr("id", "id * 20 AS v"), path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(0, 0), (1, 2), (2, 4)]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_every_format_gives_back_what_it_was_given(spark, tmp_path, fmt):
    df = spark.sql("""SELECT * FROM VALUES
        (1L, ' a, "b" ', 0.1D, TIMESTAMP_NTZ '2024-01-01 00:00:00.123456', DATE '2024-02-29', 1.10BD, true),
        (2L, 'line\\nbreak', 1e300D, TIMESTAMP_NTZ '1969-12-31 23:59:59', NULL, NULL, false),
        (3L, NULL, NULL, NULL, DATE '1900-01-01', -0.01BD, NULL), (3L, '', -0.0D, NULL, NULL, 5BD, true) AS t(i, s, d, ts, day, amount, ok)""")
    assert sinks.replace_files(df, str(tmp_path / "t"), fmt=fmt) == 4
    assert sinks.replace_files(df, str(tmp_path / "p"), fmt=fmt, partition_by=["i"], sort_within=["s"]) == 4


def test_a_failing_write_leaves_the_old_table(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    try:
        assert sinks.replace_table(spark.range(5), name) == 5
        with pytest.raises(Exception, match="no such rate"):
            sinks.replace_table(spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no such rate"))).alias("id")), name)
        assert spark.table(name).count() == 5
        assert sinks.replace_table(spark.table(name).selectExpr("id + 1 AS id", "'x' AS more"), name) == 5
        assert sorted(r["id"] for r in spark.table(name).collect()) == [1, 2, 3, 4, 5]
        left = [t.name for t in spark.catalog.listTables() if t.name.startswith(name)]
        assert left == [name]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_failing_rename_gives_the_old_table_its_name_back(spark, monkeypatch):
    name = f"t_{uuid.uuid4().hex[:8]}"
    plain = type(spark).sql
    try:
        sinks.replace_table(spark.range(5), name)

        def failing(self, text, *args, **kwargs):
            if text.startswith(f"ALTER TABLE {name}_new"):
                raise RuntimeError("rename failed")
            return plain(self, text, *args, **kwargs)
        monkeypatch.setattr(type(spark), "sql", failing)
        with pytest.raises(RuntimeError, match="rename failed"):
            sinks.replace_table(spark.range(7), name)
        assert spark.table(name).count() == 5 and [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    finally:
        monkeypatch.undo()
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_csv_without_line_breaks_is_split_between_tasks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,t\n" + "".join(f'{i},"x, ""{i}"""\n' for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        one, many = (fs.read_csv(spark, str(path), "id long, t string", multi_line=m) for m in (True, False))
        assert one.select(F.spark_partition_id()).distinct().count() == 1 and many.select(F.spark_partition_id()).distinct().count() > 3
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect())) == [(i, f'x, "{i}"') for i in range(3000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
