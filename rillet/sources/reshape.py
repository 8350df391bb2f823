"""Reshaping landed JSON into flat rows with native expressions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_json(df: DataFrame, text_col: str, schema: T.DataType | str, out: str = "doc",
               keep: Sequence[str] = (), options: Mapping[str, str] | None = None) -> DataFrame:
    """``from_json`` with an explicit schema; a corrupt record gives NULL."""
    opts = {"mode": "PERMISSIVE", **(options or {})}
    return df.select(*keep, F.from_json(F.col(text_col), schema, opts).alias(out))


def is_corrupt(text_col: str, schema: str) -> Column:
    """Whether a text is there but is no document of the ``struct<...>`` schema."""
    body = schema.strip().removeprefix("struct<").removesuffix(">")
    read = F.from_json(F.col(text_col), f"struct<{body}, _corrupt_record: string>", {"columnNameOfCorruptRecord": "_corrupt_record"})
    return F.coalesce(read["_corrupt_record"].isNotNull(), F.lit(False))


def corrupt_records(df: DataFrame, text_col: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """The rows whose text cannot be read, with the text as ``_corrupt_record``."""
    return df.filter(is_corrupt(text_col, schema)).select(*keep, F.col(text_col).alias("_corrupt_record"))


def arrays_as_text(cols: Mapping[str, str]) -> dict[str, Column]:
    """Arrays kept as JSON text, ``[]`` for a missing one."""
    return {out: F.coalesce(F.to_json(F.col(src)), F.lit("[]")) for out, src in cols.items()}


def arrays_to_rows(df: DataFrame, struct_col: str, arrays: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Dict of parallel arrays -> one row per position (``inline(arrays_zip)``).

    Shorter or missing arrays give NULL at the missing positions (a missing
    array counts as empty); a missing document gives no rows.
    """
    st = df.schema[struct_col].dataType
    cols = []
    for a in arrays:
        c = F.col(f"{struct_col}.{a}")
        empty = F.array_repeat(F.lit(None).cast(st[a].dataType.elementType), 0)
        cols.append(F.when(F.col(struct_col).isNotNull(), F.coalesce(c, empty)).alias(a))
    return df.filter(F.col(struct_col).isNotNull()).select(*keep, F.inline(F.arrays_zip(*cols)))


def zip_with_default(df: DataFrame, main: str, partner: str, keep: Sequence[str] = (),
                     default: float = 0.0) -> DataFrame:
    """Zip ``[ts, value]`` pairs by position; the row count follows ``main`` and a
    missing partner value becomes ``default`` (``arrays_zip`` would pad to the
    longer list instead)."""
    exploded = df.select(*keep, F.col(partner).alias("_partner"), F.posexplode(main).alias("pos", "_pair"))
    return exploded.select(
        *keep, "pos",
        F.get(F.col("_pair"), 0).alias("ts_ms"),
        F.get(F.col("_pair"), 1).alias("value"),
        F.coalesce(F.get(F.get(F.col("_partner"), F.col("pos")), 1), F.lit(default)).alias("partner_value"))


def keyed_object_to_rows(df: DataFrame, text_col: str, value_schema: T.StructType,
                         wanted: Sequence[str] | None = None, key_name: str = "id") -> DataFrame:
    """``{id: {measures}}`` text -> one row per id (optionally only wanted ids)."""
    m = F.from_json(F.col(text_col), T.MapType(T.StringType(), value_schema))
    out = df.select(F.explode(m).alias(key_name, "_v")).select(key_name, "_v.*")
    return out.filter(F.col(key_name).isin(list(wanted))) if wanted is not None else out


def positional(arr: Column | str, i: int, field: str | None = None, default: object = None) -> Column:
    """Item ``i`` (0-based) of an array, optional struct field, with a default."""
    a = F.col(arr) if isinstance(arr, str) else arr
    item = F.get(a, i)
    if field:
        for part in field.split("."):
            item = item[part]
    return item if default is None else F.coalesce(item, F.lit(default))


def array_sizes(cols: Mapping[str, str]) -> dict[str, Column]:
    """Array lengths as measures, 0 for a missing array."""
    return {out: F.coalesce(F.size(F.col(src)), F.lit(0)).cast("int") for out, src in cols.items()}


def child_rows(docs: DataFrame, parent_key: str, children: str, parent_id: object = None) -> DataFrame:
    """Parent/child document -> one row per child with its parent key; with
    ``parent_id`` only that parent's children (the filter runs before the
    explode, on the parent rows)."""
    d = docs if parent_id is None else docs.filter(F.col(parent_key) == F.lit(parent_id))
    return d.select(parent_key, F.explode(children).alias("_c")).select(parent_key, "_c.*")
