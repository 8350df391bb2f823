"""JSON array files: cutting into objects, reading, writing, corrupt text."""

import json
import random

import pytest

from rillet.sources import files as fs
from rillet.sources import json_array as ja


def _value(r, depth=0):
    k = r.randrange(9)
    if k < 4:
        return "".join(r.choice('ab{}[]",\\:\n\té中\U0001F600 ') for _ in range(r.randrange(9)))
    if k < 6:
        return r.randrange(99)
    if depth < 3 and k < 8:
        return {"x": _value(r, depth + 1), "y": [_value(r, depth + 1)]} if k < 7 else [_value(r, depth + 1)]
    return None


@pytest.fixture(params=["128m", "37b"])
def split_size(spark, request):
    """Whole files, and splits of a few bytes, so that objects and strings lie across splits."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1" if request.param == "37b" else "4m")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_objects_equal_the_json_library(spark, tmp_path, split_size):
    r = random.Random(5)
    want = []
    for trial, n in enumerate([0, 1, 2, 40, 40]):
        flat = trial < 4
        objects = [{"id": f"{trial}-{i}", "s": _value(r, 3 if flat else 0)} for i in range(n)]
        want += objects
        with open(tmp_path / f"f{trial}.json", "w", encoding="utf-8") as f:
            json.dump(objects, f, indent=[None, 2][trial % 2], ensure_ascii=trial % 3 == 0)
    got = [json.loads(x["json"]) for x in ja.json_array_objects(spark, str(tmp_path)).collect()]
    assert sorted(got, key=lambda x: x["id"]) == sorted(want, key=lambda x: x["id"])


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1},]', '[{"a": 1} {"a": 2}]', '[1, 2]', '[{"a": "x}]', '[{"a": 1}] x', '[[{"a": 1}]]',
                                  'x [{"a": 1}]', '[{"a": 1}, 7, {"a": 2}]', '{"a": 1}, {"a": 2}]', '[{"a": {"b": 1}]', "[", "[]]"])
def test_corrupt_arrays_raise(spark, tmp_path, text):
    path = tmp_path / "bad.json"
    path.write_text(text)
    with pytest.raises(ja.CorruptExport):
        ja.json_array_objects(spark, str(path))


def test_broken_objects_raise(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('[{"a": 1}, {"a": 1 "b"}]')
    with pytest.raises(Exception, match="(?i)malformed"):
        ja.read_json_array(spark, str(path), "a long").collect()


def test_exports_are_read_as_they_are_written(spark, tmp_path):
    """An indented array, a one-line array and JSON lines, as json.dump and the sinks write them."""
    rows = [{"id": i, "name": f'a "quoted" {{brace}} \\ {i}', "price": i / 4, "seen": None if i % 3 else f"2024-01-0{1 + i % 9}T00:00:00"} for i in range(9)]
    for name, indent in (("indented", 2), ("line", None)):
        with open(tmp_path / f"{name}.json", "w") as f:
            json.dump(rows, f, indent=indent)
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)) + "\n")
    exports = {n: str(tmp_path / f"{n}.json") for n in ("indented", "line", "lines")}
    for name in exports:
        df, n = fs.read_exported_json(spark, exports, name)
        assert n == 9 and sorted((x.asDict() for x in df.collect()), key=lambda x: x["id"]) == rows
    with pytest.raises(KeyError):
        fs.read_exported_json(spark, exports, "other")
    (tmp_path / "lines.json").write_text('{"id": 1}\n{"id": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        fs.read_exported_json(spark, exports, "lines")


@pytest.mark.parametrize("pretty", [True, False])
def test_written_arrays_are_arrays(spark, tmp_path, pretty):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else f"t{i}}}") for i in range(25)], "id long, t string").repartition(3)
    path = str(tmp_path / "out")
    assert ja.write_json_array(df, path, ["id"], pretty=pretty, rows_per_file=10) == 25
    parts = sorted((tmp_path / "out").glob("part=*/*.txt"))
    arrays = [json.loads(p.read_text()) for p in parts]
    assert [len(a) for a in arrays] == [10, 10, 5] and [x for a in arrays for x in a] == [{"id": i, "t": None if i % 4 == 0 else f"t{i}}}"} for i in range(25)]
    assert all((p.read_text().strip().count("\n") > 0) == pretty for p in parts)
    back = ja.read_json_array(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()), key=lambda x: x[0])


def test_a_file_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "one.json"
    path.write_text(json.dumps([{"id": i, "t": "x" * 50} for i in range(2000)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        pieces = ja._pieces(spark, str(path))
        assert pieces.select("block").distinct().count() > 10
        assert ja.read_json_array(spark, str(path)).count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_texts_stay_where_they_were_written(spark, tmp_path):
    """Depths reach the written pieces as one row a split, whatever the planner takes for small, and with a
    schema no second copy of the texts is written."""
    from pathlib import Path

    from rillet.session import checkpoint_dir
    path = tmp_path / "one.json"
    rows = [{"id": i, "t": '}{"' * (i % 3) + "x" * 50} for i in range(300)]
    path.write_text(json.dumps(rows))
    scratch = Path(checkpoint_dir(spark).removeprefix("file:")) / "rillet"
    before = set(scratch.glob("json-lines-*"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = ja.read_json_array(spark, str(path), "id long, t string")
        got = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            spark.conf.unset(c)
    assert sorted((r.asDict() for r in got), key=lambda r: r["id"]) == rows
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert set(scratch.glob("json-lines-*")) == before
    newest = max(scratch.glob("json-pieces-*"), key=lambda p: p.stat().st_mtime)
    assert all(p.name.endswith(".zstd.parquet") for p in newest.glob("part-*"))
