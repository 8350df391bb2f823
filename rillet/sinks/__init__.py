"""Sinks: full-replace tables (files, catalog or JDBC) that are checked by content before they
replace anything, JSON export with type coercion, and multi-sink jobs.

What is written is counted and summed up on the way (``observe``, no extra pass): the number
of rows and the sum of a 64-bit hash of each, which does not depend on their order and
changes with any value. The same is computed of what is read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillet.session import materialized


class VerificationError(RuntimeError):
    """What was read back is not what was written."""


class RowCountMismatch(VerificationError):
    pass


class ContentMismatch(VerificationError):
    pass


class SinksFailed(RuntimeError):
    """Some of several sinks failed; ``done`` has the row counts of the others, ``failed`` the errors."""

    def __init__(self, done: dict[str, int], failed: dict[str, Exception]) -> None:
        super().__init__(f"sinks failed: {', '.join(f'{k}: {v}' for k, v in failed.items())}")
        self.done, self.failed = done, failed


def _hashable(field: T.StructField, blank_is_null: bool) -> F.Column:
    c = F.col(f"`{field.name}`")
    if "map<" in field.dataType.simpleString():
        return F.to_json(c)
    return F.nullif(c, F.lit("")) if blank_is_null and isinstance(field.dataType, T.StringType) else c


def content(schema: T.StructType, blank_is_null: bool = False) -> list[F.Column]:
    """Aggregates that describe a multiset of rows: how many, and the sum of their hashes. Nulls have a hash of their own,
    and columns are taken in the given order, whatever the order they are read in. ``blank_is_null`` takes
    empty text for missing, which CSV cannot tell apart."""
    values = [_hashable(f, blank_is_null) for f in schema.fields]
    row = F.xxhash64(F.lit(len(schema)), *[x for k, c in enumerate(values) for x in (F.when(c.isNull(), k), c)])
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row.cast("decimal(28,0)")), F.lit(0).cast("decimal(38,0)")).alias("hashes")]


def _observed(df: DataFrame, name: str, blank_is_null: bool = False) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, *content(df.schema, blank_is_null)), obs


def _verify(target: str, obs: Observation, schema: T.StructType, back: DataFrame, blank_is_null: bool = False) -> None:
    rows, hashes = back.agg(*content(schema, blank_is_null)).first()
    if rows != obs.get["rows"]:
        raise RowCountMismatch(f"{target}: wrote {obs.get['rows']} rows, read back {rows}")
    if hashes != obs.get["hashes"]:
        raise ContentMismatch(f"{target}: {rows} rows read back differ from the rows written")


def _swap(spark, new: str, path: str) -> None:
    """Move a finished folder into place; the old one goes only after the new one stands."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src, dst, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (new, path, f"{new}-old"))
    fs = dst.getFileSystem(conf)
    had = fs.exists(dst)
    if had and not fs.rename(dst, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(src, dst):
        if had:
            fs.rename(old, dst)
        raise OSError(f"cannot move {new} to {path}")
    if had:
        fs.delete(old, True)


#: Text formats keep what they are given: blanks around values, microseconds, quotes inside values (doubled, as CSV readers expect).
_TEXT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
OPTIONS = {"csv": {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, **_TEXT_TIMES},
           "json": _TEXT_TIMES}


def replace_files(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                  sort_within: Sequence[str] = (), verify: bool = True) -> int:
    """Replace a folder: write beside it, compare count and content of what is read back with
    what was observed, then swap, so a failed write leaves the old data. Returns the row count.

    ``partition_by`` + ``sort_within`` lay out time-series output so readers
    prune partitions and Parquet row groups (min/max statistics) instead of
    relying on indexes.
    """
    path = path.rstrip("/")
    new = f"{path}-new-{uuid.uuid4().hex}"
    out, obs = _observed(df, f"write_{uuid.uuid4().hex}", fmt == "csv")
    if sort_within:
        out = out.sortWithinPartitions(*partition_by, *sort_within)
    options = OPTIONS.get(fmt, {})
    w = out.write.format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(new)
    if verify:
        reader = df.sparkSession.read.format(fmt).options(**options).schema(df.schema)
        _verify(path, obs, df.schema, (reader.option("multiLine", True) if fmt == "csv" else reader).load(new), fmt == "csv")
    _swap(df.sparkSession, new, path)
    return int(obs.get["rows"])


def replace_table(df: DataFrame, table: str, verify: bool = True) -> int:
    """Replace a catalog table: a table beside it is written and checked, then the names are
    changed. Until then the old table stands as it is (the new rows may come from it); if the
    last step fails it gets its name back. Returns the row count."""
    spark, mark = df.sparkSession, uuid.uuid4().hex[:8]
    new, old = f"{table}_new_{mark}", f"{table}_old_{mark}"
    out, obs = _observed(df, f"table_{mark}")
    try:
        out.write.saveAsTable(new)
        if verify:
            _verify(table, obs, df.schema, spark.table(new))
        had = spark.catalog.tableExists(table)
        if had:
            spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
        except Exception:
            if had:
                spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
            raise
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    if had:
        spark.sql(f"DROP TABLE {old}")
    return int(obs.get["rows"])


def replace_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
                 batch_size: int = 1000, connections: int = 16, verify: bool = True) -> int:
    """Overwrite a JDBC table in batches of ``batch_size`` rows per statement, over at most
    ``connections`` connections, and compare the row counts afterwards."""
    # Dealt out before the write, so upstream tasks stay as many as they are.
    out, obs = _observed(df.repartition(connections), f"jdbc_{uuid.uuid4().hex}")
    props = dict(properties or {})
    (out.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table)
     .option("batchsize", batch_size).options(**props).save())
    written = int(obs.get["rows"])
    if verify:
        back = (df.sparkSession.read.format("jdbc").option("url", url)
                .option("query", f"SELECT COUNT(*) AS n FROM {table}").options(**props).load().first()[0])
        if int(back) != written:
            raise RowCountMismatch(f"{table}: wrote {written} rows, read back {back}")
    return written


def export_shape(df: DataFrame, order: Sequence[str], limit: int | None = None) -> DataFrame:
    """Rows as the JSON export writes them: timestamps and dates as ISO text,
    decimals as doubles; an export cap only where the caller asks for one."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    out = df.select(*cols).orderBy(*order)
    return out.limit(limit) if limit else out


def export_json(df: DataFrame, path: str, order: Sequence[str], limit: int | None = None) -> int:
    return replace_files(export_shape(df, order, limit), path, fmt="json")


def write_many(frames: Mapping[str, DataFrame], writer) -> dict[str, int]:
    """Several sinks from one job: empty results skip their sink; a failing sink does not stop
    the others, and all failures are raised together at the end (``SinksFailed``)."""
    done, failed = {}, {}
    for name, df in frames.items():
        try:
            rows = materialized(df, f"sink-{name}")  # evaluated once, for the test and the write
            if rows.isEmpty():
                continue
            done[name] = writer(name, rows)
        except Exception as e:  # noqa: BLE001 - collected and re-raised below
            failed[name] = e
    if failed:
        raise SinksFailed(done, failed)
    return done


def with_processing_time(df: DataFrame, name: str = "processed_at", as_of: str | None = None) -> DataFrame:
    """Stamp every row at the sink: the query start time, or a fixed ``as_of``
    (reproducible runs and comparisons)."""
    ts = F.lit(as_of).cast("timestamp_ntz") if as_of else F.current_timestamp().cast("timestamp_ntz")
    return df.withColumn(name, ts)
