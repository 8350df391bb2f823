"""JSON array files -> rows, however large a file is and whether or not it has line breaks.

A file is read in pieces that end at a closing brace, which Spark's text source splits
between tasks like lines. Within a piece the depth of braces only rises, so an object ends
exactly where a piece ends at depth 0 outside a string. Whether a piece starts inside a
string follows from the quotes before it, its depth from the braces outside strings before
it: both are running sums, kept for either start within a split of the file and fixed by
one row a split. A backslash never stands before a brace in JSON, so no escape is cut.

Objects of one piece, the flat ones, are found where they lie; only objects with braces of
their own are put together from their pieces. The text between objects is checked.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillet.session import checkpoint_dir, materialized


class CorruptExport(ValueError):
    pass


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block (where the split starts), at (rising within a split), value without its closing brace."""
    return (spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("at"), "value"))


def _opened(text: Column) -> Column:
    """Opening braces outside strings of a text that starts outside one."""
    plain = F.regexp_replace(text, r'"[^"]*("|$)', "")
    return F.length(plain) - F.length(F.replace(plain, F.lit("{"), F.lit("")))


def _with_depths(pieces: DataFrame) -> DataFrame:
    """Pieces with the depth before and after them, and whether a string is open at their end."""
    bare = F.regexp_replace("value", r"\\.", "")  # without escapes
    last = Window.partitionBy("file").orderBy(F.desc("block"))
    counted = (pieces.withColumn("_bare", bare)
               .withColumn("_quotes", F.length("_bare") - F.length(F.replace("_bare", F.lit('"'), F.lit(""))))
               .withColumn("_odd", F.pmod("_quotes", F.lit(2)))
               .withColumn("_out", _opened(F.col("_bare")))
               .withColumn("_in", _opened(F.regexp_replace("_bare", r'^[^"]*("|$)', ""))))
    order = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    run = counted.withColumn("_parity", F.sum("_odd").over(order)).withColumn("_before", F.pmod(F.col("_parity") - F.col("_odd"), F.lit(2)))
    # The change of depth if the split starts outside (0) or inside (1) a string; a brace within a string closes nothing.
    for start in (0, 1):
        inside = F.pmod(F.col("_before") + start, F.lit(2))
        ends_inside = F.pmod(F.col("_parity") + start, F.lit(2))
        run = run.withColumn(f"_step{start}", F.when(inside == 0, F.col("_out")).otherwise(F.col("_in")) - F.when(ends_inside == 0, 1).otherwise(0))
        run = run.withColumn(f"_run{start}", F.sum(f"_step{start}").over(order))
    run = materialized(run.drop("_bare", "_quotes", "_out", "_in", "_odd", "_before"), "json-pieces", "zstd")
    splits = run.groupBy("file", "block").agg(*(F.max_by(c, "at").alias(c) for c in ("_parity", "_run0", "_run1")), F.max("at").alias("_last"),
                                             F.min("at").alias("_first"))
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_start", F.pmod(F.coalesce(F.sum("_parity").over(upto), F.lit(0)), F.lit(2)))
    splits = splits.withColumn("_base", F.coalesce(F.sum(F.when(F.col("_start") == 0, F.col("_run0")).otherwise(F.col("_run1"))).over(upto), F.lit(0)))
    splits = splits.withColumn("_final", F.row_number().over(last) == 1).withColumn("_initial", F.row_number().over(Window.partitionBy("file").orderBy("block")) == 1)
    # One row a split: the pieces stay where they were written.
    known = run.join(F.broadcast(splits.drop("_parity", "_run0", "_run1")), ["file", "block"])
    pick = lambda c: F.when(F.col("_start") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1"))
    ends = F.pmod(F.col("_parity") + F.col("_start"), F.lit(2)) == 1
    return (known.withColumn("after", F.col("_base") + pick("_run")).withColumn("before", F.col("after") - pick("_step"))
            .withColumn("open_string", ends)
            .select("file", "block", "at", "value", "before", "after", "open_string",
                    (F.col("_initial") & (F.col("at") == F.col("_first"))).alias("first"), (F.col("_final") & (F.col("at") == F.col("_last"))).alias("last")))


def json_array_objects(spark: SparkSession, path: str) -> DataFrame:
    """file and json of every object of the JSON arrays in a file or folder, on one line each.

    A file that is no array of objects (text around or between them, an open string, a
    missing bracket) raises ``CorruptExport``; objects themselves are not parsed here.
    """
    pieces = _with_depths(_pieces(spark, path))
    lead = F.regexp_extract("value", r"^[^{]*", 0)
    # The last piece of a file has no brace behind it, so its depth counts one too few.
    tail = F.col("last") & (F.col("value").rlike(r"^\s*\]\s*$") | (F.col("first") & F.col("value").rlike(r"^\s*\[\s*\]\s*$")))
    sound = (F.when(F.col("last"), tail & (F.col("before") == 0) & ~F.col("open_string"))
             .when(F.col("before") == 0, F.when(F.col("first"), lead.rlike(r"^\s*\[\s*$")).otherwise(lead.rlike(r"^\s*,\s*$")) & F.col("value").contains("{"))
             .otherwise(F.col("before") > 0))
    wrong = pieces.filter(~F.coalesce(sound, F.lit(False))).select("file").first()
    if wrong:
        raise CorruptExport(f"{wrong['file']} is not an array of JSON objects")
    body = pieces.filter(~F.col("last"))
    text = F.concat("value", F.lit("}"))
    whole = body.filter((F.col("before") == 0) & (F.col("after") == 0) & ~F.col("open_string")).select("file", text.alias("json"))
    parts = body.filter((F.col("before") != 0) | (F.col("after") != 0) | F.col("open_string"))
    # An object begins at the last piece of depth 0: in this split, else in the last split before that has one.
    begun = F.when(F.col("before") == 0, F.struct("block", "at"))
    here = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("_own", F.last(begun, ignorenulls=True).over(here))
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.groupBy("file", "block").agg(F.max("_own").alias("_o")).select("file", "block", F.last("_o", ignorenulls=True).over(upto).alias("_carried"))
    joined = parts.join(F.broadcast(carried), ["file", "block"]).withColumn("_object", F.coalesce("_own", "_carried"))
    nested = joined.groupBy("file", "_object").agg(F.array_sort(F.collect_list(F.struct("block", "at", text.alias("t")))).alias("p")) \
        .select("file", F.array_join(F.transform("p", lambda x: x["t"]), "").alias("json"))
    # Line breaks stand only between tokens.
    return whole.unionByName(nested).select("file", F.translate(F.regexp_replace("json", r"^[^{]*", ""), "\r\n", "  ").alias("json"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Rows of the JSON arrays in a file or folder; types are inferred where no schema is given.

    With a schema the objects are parsed as they are cut from the written pieces. Without one
    they are written once as packed JSON lines under the shared scratch folder and read from
    there, so inference and the read are the ordinary ones. Broken objects raise.
    """
    objects = json_array_objects(spark, path).select("json")
    if schema is not None:
        return objects.select(F.from_json("json", schema, {"mode": "FAILFAST"}).alias("_row")).select("_row.*")
    lines = f"{checkpoint_dir(spark).rstrip('/')}/rillet/json-lines-{uuid.uuid4().hex}"
    objects.write.option("compression", "gzip").text(lines)
    return spark.read.option("mode", "FAILFAST").json(lines)


def holds_arrays(spark: SparkSession, path: str) -> bool:
    """Whether the first file with text begins with a bracket; only its first piece is read."""
    first = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path).filter(F.trim("value") != "").first()
    return first is not None and first["value"].lstrip().startswith("[")


def write_json_array(df: DataFrame, path: str, order: list[str], pretty: bool = True, rows_per_file: int = 1 << 20) -> int:
    """Write rows in the given order as JSON array files, null fields included. Returns the row count.

    Up to ``rows_per_file`` rows make one file of a folder of their own (``part=0`` ...): files are valid
    arrays by themselves and no task holds more than one. ``pretty`` breaks and indents objects, else a
    file is one line.
    """
    from rillet.operators.ranking import with_global_index
    numbered = with_global_index(df, [F.col(f"`{c}`") for c in order], "_rn")
    total = numbered.count()
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    at = F.pmod(F.col("_rn") - 1, F.lit(rows_per_file))
    text = F.to_json(row, {"pretty": str(pretty).lower(), "ignoreNullFields": "false"})
    text = F.concat(F.when(at == 0, "[").otherwise(""), text, F.when((at == rows_per_file - 1) | (F.col("_rn") == total), "]").otherwise(","))
    parts = numbered.select(F.floor((F.col("_rn") - 1) / rows_per_file).alias("part"), "_rn", text.alias("value"))
    writer = parts.repartition("part").sortWithinPartitions("part", "_rn").select("part", "value").write.partitionBy("part")
    writer.option("lineSep", "\n" if pretty else " ").text(path)
    return total
