"""The corpus pipeline: toxicity, language, line dedup, near-dedup, packing.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet
and read again as the next stage's docs. All stages but the last return the columns of
``documents``. Models are learned from the tables in ``sf_dir``; what a stage decides,
counts or searches covers all rows that reach it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rillet.llm import langid, line_dedup, near_dedup, packing, toxicity
from rillet.llm.common import landed


#: Rows of whole texts that a Python worker gets at a time.
ROWS_AT_A_TIME = 2000


def _few_rows_at_a_time(spark: SparkSession) -> None:
    """Bounds what the workers of a stage hold: by default a batch has 10000 rows, however long their texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_A_TIME)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (5): documents that score 0.7 or more go."""
    _few_rows_at_a_time(spark)
    source, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.drop_toxic(docs, toxicity.learn_lexicon(source, labels))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (7): documents without letters, or in none of the learned languages, go."""
    _few_rows_at_a_time(spark)
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.learn_filters(source)
    return langid.keep_identified(docs, model, langid.learn_floors(source, model))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup (3): repeated lines go, and documents of which only blank lines are left."""
    return line_dedup.without_repeats(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup (8): the document with the smallest id of each class stays."""
    _few_rows_at_a_time(spark)
    return near_dedup.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (6): every document's tokens in sequences of at most 2048."""
    _few_rows_at_a_time(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("language_id", keep_identified), ("line_dedup", drop_repeated_lines),
          ("near_dedup", drop_near_duplicates), ("packing", pack)]

#: No SQL: learned models, a tokenizer and a linear program are not expressible. The tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = landed(docs, f"stage-{name}")
    return docs
