"""Flows on landed sources: files of a format in, the flow's frame out."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.plans import creatures, cross_validation, indicators, launches, pages, retail, threat, weather
from rillet.sources.files import fan_in, read_csv, read_pages

Sources = Mapping[str, DataFrame]


def read_source(spark: SparkSession, text: str) -> DataFrame:
    """``format:path``. csv: header files; parquet; json: one document per line, as text in
    the column ``json``; rows: one JSON object per line, as columns; html: one page per
    file, with its number."""
    fmt, _, path = text.partition(":")
    if fmt == "csv":
        return read_csv(spark, path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "json":
        return spark.read.text(path).withColumnRenamed("value", "json")
    if fmt == "rows":
        return spark.read.json(path)
    if fmt == "html":
        return read_pages(spark, path, "text", {"wholetext": "true"}).withColumnRenamed("value", "html")
    raise ValueError(f"unknown format {fmt!r} in {text!r}")


def _weather(sources: Sources, as_of: str | None) -> DataFrame:
    rows = fan_in(sources, "region").withColumn("time", F.col("time").cast("timestamp_ntz"))
    return weather.flow_weather(rows)


#: Flow -> (names of its sources, None: any; the flow on them).
FLOWS: dict[str, tuple[list[str] | None, Callable[[Sources, str | None], DataFrame]]] = {
    "flow_listings": (["listings"], lambda s, _: pages.flow_listings(s["listings"])),
    "flow_posts": (["pages"], lambda s, _: pages.flow_posts(s["pages"])),
    "flow_threat": (["packets"], lambda s, _: threat.flow_threat(s["packets"])),
    "flow_indicators": (["bars"], lambda s, _: indicators.flow_indicators(s["bars"])),
    "flow_retail_cross": (["shopping", "titles"], lambda s, _: retail.flow_retail_cross(s["shopping"], s["titles"])),
    "flow_legendary": (["entities", "species"], lambda s, _: creatures.flow_legendary(s["entities"], s["species"])),
    "flow_quality_branch": (["launches", "rockets", "pads"], lambda s, a: launches.flow_quality_branch(s["launches"], s["rockets"], s["pads"], a)),
    "flow_cross_validation": (["spot", "fine", "coarse", "metadata"], lambda s, _: cross_validation.flow_cross_validation(s["spot"], s["fine"], s["coarse"], s["metadata"])),
    "flow_weather": (None, _weather),
}


def run_flow(spark: SparkSession, flow: str, sources: Mapping[str, str], as_of: str | None = None) -> DataFrame:
    """A flow on ``{source name: format:path}``; a missing or unknown name is an error."""
    if flow not in FLOWS:
        raise ValueError(f"{flow} takes no sources; those that do: {', '.join(FLOWS)}")
    names, fn = FLOWS[flow]
    if names is not None and set(names) != set(sources):
        raise ValueError(f"{flow} needs the sources {', '.join(names)}")
    return fn({k: read_source(spark, v) for k, v in sources.items()}, as_of)
