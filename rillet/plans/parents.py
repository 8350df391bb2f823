"""Parent/child catalogue: per-parent profile, complexity, tags, ordinal sort,
paging and first-seen group colouring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.functions.rules import classify
from rillet.operators.aggregate import parent_profile
from rillet.operators.combine import tag_array, tags_contain_all
from rillet.operators.ranking import ordinal_key, page

COMPLEXITY_ORDER = ["beginner", "intermediate", "advanced"]


def profiles(parents: DataFrame, children: DataFrame, special: str = "R") -> DataFrame:
    """Every parent, with its child profile (parents without children: 0/false)."""
    prof = parent_profile(children, "parent_id", "stage_type", special, "child_id")
    flags = children.groupBy("parent_id").agg(
        F.bool_or(F.col("stage_status") == "O").alias("has_open"),
        F.bool_or(F.col("stage_status") == "F").alias("has_filled"))
    out = parents.join(prof, "parent_id", "left").join(flags, "parent_id", "left")
    out = out.fillna({"has_special": False, "n_children": 0, "n_types": 0, "has_open": False, "has_filled": False})
    n = F.col("n_children")
    return out.withColumn("complexity", classify(
        [(F.col("has_special") | (n >= 7), "advanced"), (n >= 4, "intermediate")], "beginner"))


# Tags by the kind of source a parent reads.
SOURCE_TAGS = {"api": "API", "file": "CSV", "web_scraping": "Web Scraping"}


def with_tags(df: DataFrame) -> DataFrame:
    rules = [(F.col("source_type") == k, tag) for k, tag in SOURCE_TAGS.items()] if "source_type" in df.columns else []
    return df.withColumn("tags", tag_array([*rules, (F.col("has_special"), "Branching"),
                                            (F.col("has_open"), "Transform"),
                                            (F.col("has_filled"), "Database")]))


def filter_tags(df: DataFrame, wanted: list[str]) -> DataFrame:
    return with_tags(df).filter(tags_contain_all(F.col("tags"), wanted))


def complexity_page(df: DataFrame, offset: int, size: int = 10) -> DataFrame:
    return page(df.withColumn("complexity_rank", ordinal_key("complexity", COMPLEXITY_ORDER)),
                [F.col("complexity_rank"), F.col("parent_id")], offset, size)


def colour_key() -> F.Column:
    """Children that run in parallel share their group's key; the others go by their number."""
    return F.coalesce(F.col("parallel_group").cast("string"), F.col("stage_number").cast("string"))


def group_colours(children: DataFrame, palette: int = 6, key: F.Column | None = None) -> DataFrame:
    """Per parent, each child's colour slot: the rank of its group key by first
    appearance (lowest stage number), modulo the palette. The ranking window
    runs over (parent, key) pairs, at most the key domain per parent."""
    keyed = children.withColumn("_key", colour_key() if key is None else key)
    firsts = keyed.groupBy("parent_id", "_key").agg(F.min("stage_number").alias("_first"))
    w = Window.partitionBy("parent_id").orderBy("_first", "_key")
    idx = firsts.select("parent_id", "_key",
                        F.pmod(F.row_number().over(w) - 1, F.lit(palette)).cast("int").alias("colour_index"))
    return keyed.join(idx, ["parent_id", "_key"], "left").drop("_key")
