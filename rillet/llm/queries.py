"""One query per operator over whole tables, the documents pipeline, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.llm import (bpe, fingerprints, langid, licenses, line_dedup, mixing, near_dedup, packing, quality, runs, sharding, spelling,
                        toxicity)
from rillet.llm.common import learning_rows, let, words
from rillet.llm.oracle import ORACLES  # noqa: F401

Builder = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_documents(spark, sf_dir), shards=8)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_documents(spark, sf_dir))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_documents(spark, sf_dir))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_documents(spark, sf_dir)).drop("expressions", "spans")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    scored = toxicity.score_toxicity(docs, toxicity.learn_lexicon(docs, _labels(spark, sf_dir)))
    return scored.select("doc_id", (~learning_rows("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = langid.identify_languages(docs, langid.learn_filters(docs))
    return found.select("doc_id", (~learning_rows("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_classes(_documents(spark, sf_dir), width=2, percent=80)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(_documents(spark, sf_dir))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def _repeated_words(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which every tenth document by its id's checksum repeats some of its words.

    With h the crc32 of the id in decimal, g = h / 10 and n words, a text with h % 10 = 0 has
    each word i >= a replaced by word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) / (3 + g % 8). Its words are then parted by single blanks.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(w):
        n = F.size(w).cast("long")
        first = g % n
        period = F.floor((n - first) / (3 + g % 8)).cast("long") + 1
        return F.when(n > 0, F.array_join(F.transform(w, lambda x, i: F.when(i < first, x).otherwise(
            F.get(w, (first + (i - first) % period).cast("int")))), " ")).otherwise(F.lit(""))
    return docs.select("doc_id", F.when(h % 10 == 0, let(words(F.col("text")), repeated)).otherwise(F.col("text")).alias("text"))


def _run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run with the greatest length / period (ties: smallest start, then period) and
    digests of all runs and of the collapsed text."""
    best = F.aggregate("runs", F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda a, r: F.when(
        a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Whole texts: by default the Parquet reader holds 4096 of them at a time, and a batch for the worker 10000.
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", 512)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    return _run_digests(runs.periodic_runs(_repeated_words(_documents(spark, sf_dir))))


def _with_slips(found: DataFrame) -> DataFrame:
    """doc_id and word, in which every 31st use of a word by its checksum lacks a code point.

    With h the crc32 of ``<doc_id>:<word>``, a word with h % 31 = 0 loses its code point h % length.
    """
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    at = (h % F.char_length("word")).cast("int")
    return found.select("doc_id", F.when(h % 31 == 0, F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word"))))
                        .otherwise(F.col("word")).alias("word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = _with_slips(spelling.words_of(_documents(spark, sf_dir)))
    return spelling.group_variants(spelling.count_words(used))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


QUERIES: dict[str, Builder] = {f.__name__: f for f in (
    op1_sharding, op2_fingerprints, op3_line_dedup, op4_license_scans, op5_toxicity, op6_packing, op7_language_id, op8_near_dedup,
    op9_quality_rules, op10_byte_bpe, op11_periodic_runs, op12_spelling_variants, op13_source_mixing)}
