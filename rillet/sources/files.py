"""File sources: CSV with pandas-like NA handling, JSON documents, multi-source fan-in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillet.sources.json_array import holds_arrays, read_json_array

# Text that pandas reads as missing by default.
PANDAS_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _found(spark: SparkSession, paths: Sequence[str], glob: str | None) -> list[str]:
    """Files or folders to read: a named file as it is, a folder's files by the pattern."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if glob and fs.exists(hp) and fs.getFileStatus(hp).isDirectory():
            hp = jvm.org.apache.hadoop.fs.Path(hp, glob)
        hits = fs.globStatus(hp)
        if not hits:
            raise FileNotFoundError(f"no file matches {hp.toString()}")
        out.append(hp.toString())
    return out


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             glob: str | None = "*.csv", na_tokens: Sequence[str] = PANDAS_NA_TOKENS, multi_line: bool = True) -> DataFrame:
    """Header CSV scan: doubled quotes and line breaks inside quotes are part of the value,
    every pandas NA token becomes NULL, blanks are kept. A folder is read by ``glob``, a
    named file whatever its ending; no match is an error.

    With ``multi_line`` a file is read by one task, since a line break inside quotes cannot
    be told from the end of a record anywhere in a file. Files whose values hold no line
    breaks should be read with ``multi_line=False``: Spark then splits a file between tasks.
    (There, a value with a line break would end its record.)

    With a schema the read is typed. Without one, a column is boolean, long or double if
    all its values that are not NA tokens are, else text.
    """
    paths = _found(spark, [path] if isinstance(path, str) else list(path), glob)
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("multiLine", multi_line).option("escape", '"')
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if schema is None:
        raw = nulls_for_tokens(reader.option("inferSchema", False).csv(paths), na_tokens)
        fields = inferred_types(raw)
    else:
        st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        fields = {f.name: f.dataType for f in st.fields}
        raw = nulls_for_tokens(reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in fields])).csv(paths), na_tokens)
    return raw.select(*[F.col(f"`{n}`") if t == T.StringType() else F.trim(F.col(f"`{n}`")).try_cast(t).alias(n) for n, t in fields.items()])


def inferred_types(df: DataFrame) -> dict[str, T.DataType]:
    """The narrowest of boolean, long and double that holds all values of a text column, else text. One pass."""
    kinds = (T.BooleanType(), T.LongType(), T.DoubleType())
    checks, cols = [F.lit(1).alias("_one")], df.columns
    for i, c in enumerate(cols):
        v = F.trim(F.col(f"`{c}`"))
        fits = (F.lower(v).isin("true", "false"), v.rlike(r"^[+-]?\d+$") & v.try_cast("long").isNotNull(), v.try_cast("double").isNotNull())
        checks += [F.count(v).alias(f"n{i}")] + [F.count_if(F.col(f"`{c}`").isNull() | ok).alias(f"k{i}_{j}") for j, ok in enumerate(fits)]
    row = df.agg(F.count("*").alias("rows"), *checks[1:]).first()
    return {c: next((t for j, t in enumerate(kinds) if row[f"n{i}"] and row[f"k{i}_{j}"] == row["rows"]), T.StringType()) for i, c in enumerate(cols)}


def nulls_for_tokens(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Text that is exactly a token becomes NULL."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(list(tokens)), F.col(f"`{c}`")) for c in strings})


def fan_in(sources: Mapping[str, DataFrame | None], tag: str = "source") -> DataFrame:
    """Union of named sources, each tagged with its name; missing ones are left out."""
    frames = [df.withColumn(tag, F.lit(name)) for name, df in sources.items() if df is not None]
    if not frames:
        raise ValueError("no source available")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_paths_tagged(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet",
                      tag: str = "source") -> DataFrame:
    """One read per existing path, tagged and unioned (absent paths skipped)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = {}
    for name, p in paths.items():
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            found[name] = spark.read.format(fmt).load(p)
    return fan_in(found, tag)


def read_exported_json(spark: SparkSession, exports: Mapping[str, str], dataset: str) -> tuple[DataFrame, int]:
    """Read back one exported dataset by name with its row count; an unknown name is an error.

    An export is a file or folder of JSON arrays, indented or not (``json_array``), or of
    JSON lines. Text that is neither raises.
    """
    if dataset not in exports:
        raise KeyError(f"unknown dataset {dataset!r}")
    path = exports[dataset]
    df = read_json_array(spark, path) if holds_arrays(spark, path) else spark.read.option("mode", "FAILFAST").json(path)
    return df, df.count()


def sql_query(spark: SparkSession, text: str) -> DataFrame:
    """SQL text -> frame over registered views; errors are raised, not hidden."""
    return spark.sql(text)


def read_pages(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet",
               options: Mapping[str, str] | None = None) -> DataFrame:
    """Paged source: every file that has rows is one page; ``page_no`` is the rank of its
    name, counted by the distributed numbering, so no file list reaches the driver."""
    from rillet.operators.ranking import with_global_index
    tagged = spark.read.format(fmt).options(**dict(options or {})).load(path).withColumn("_file", F.input_file_name())
    numbered = with_global_index(tagged.select("_file").distinct(), [F.col("_file")], "page_no", tie_break=False)
    return tagged.join(numbered, "_file").drop("_file")


def read_jdbc_query(spark: SparkSession, url: str, query: str, properties: Mapping[str, str] | None = None,
                    partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """SQL text run by a JDBC database -> frame; errors are raised. With a
    partition column and bounds the read is split into parallel range queries
    (``query`` is then wrapped as a table subquery, as Spark requires)."""
    r = spark.read.format("jdbc").option("url", url).options(**dict(properties or {}))
    if partition_column:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
             .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", num_partitions or 8))
    else:
        r = r.option("query", query)
    return r.load()
