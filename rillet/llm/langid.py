"""Language identification with language-bitmask n-gram filters.

One Bloom filter holds the frequent letter trigrams of all languages: a slot is a bit
mask of languages, so one AND over the slots of a trigram returns every language that
contains it. A text's hits are counted per language, the hits expected by chance from
each language's fill are taken off, and the largest share decides. Whether a text is in
that language at all is decided by how much of it the language covers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import held, landed, learning_rows, rows_kept, stable_share, tidied

#: Rows to learn a language from, about so many at most.
SAMPLE_PER_LANGUAGE = 2_000
#: A language contains a trigram that makes up this share of its trigrams, so at most 1 / SHARE of them.
SHARE = 2e-4
SLOT_BITS, PROBES = 18, 3
LANGUAGES = 64  # bits of a slot
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def trigram_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the letter trigrams of the lower-cased text; runs of other characters are one blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.uint64)
    codes = np.where(letter, codes, 32).astype(np.uint64)
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # the first blank of a run stays
    codes = np.concatenate([np.array([32], np.uint64), codes[keep], np.array([32], np.uint64)])
    packed = codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:]
    packed = packed[codes[1:-1] != 32]  # centred on a letter
    packed = (packed ^ (packed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    packed = (packed ^ (packed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return packed ^ (packed >> np.uint64(32))


def _slots(hashes: np.ndarray) -> list[np.ndarray]:
    """PROBES independent slots of each hash: disjoint bits of it."""
    return [(hashes >> np.uint64(k * SLOT_BITS)) & np.uint64((1 << SLOT_BITS) - 1) for k in range(PROBES)]


class Filters:
    """The bit-sliced filter: a 64-bit language mask per slot."""

    def __init__(self, languages: tuple[str, ...], grams: list[tuple[int, int]]) -> None:
        """grams: (language number, signed 64-bit hash)."""
        self.languages = languages
        self.masks = np.zeros(1 << SLOT_BITS, np.uint64)
        if grams:
            which = np.array([g[0] for g in grams], np.uint64)
            for s in _slots(np.array([g[1] for g in grams], np.int64).view(np.uint64)):
                np.bitwise_or.at(self.masks, s.astype(np.int64), np.uint64(1) << which)
        fill = [float(((self.masks >> np.uint64(k)) & np.uint64(1)).mean()) for k in range(len(languages))]
        self.chance = np.array([f ** PROBES for f in fill])

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Trigrams that each language contains, less those expected by chance."""
        a, b, c = (self.masks[s.astype(np.int64)] for s in _slots(hashes))
        found = a & b & c
        got = np.array([np.count_nonzero(found & np.uint64(1 << k)) for k in range(len(self.languages))], float)
        return np.maximum(0.0, (got - len(hashes) * self.chance) / (1 - self.chance))

    def covered(self, text: str | None) -> tuple[int, float, int]:
        """Number of the language with the most hits, its hits among the text's trigrams, their number."""
        hashes = trigram_hashes(text or "")
        if not len(hashes) or not self.languages:
            return 0, 0.0, 0
        hits = self.hits(hashes)
        return int(hits.argmax()), float(hits.max() / len(hashes)), len(hashes)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and share of its hits among all hits; equal hits go to the first language by name."""
        hashes = trigram_hashes(text or "")
        if not len(hashes) or not self.languages:
            return UNKNOWN, 0.0
        hits = self.hits(hashes)
        k = int(hits.argmax())
        return self.languages[k], float(hits[k] / hits.sum()) if hits.sum() else 0.0


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        by: dict[int, list[np.ndarray]] = {}
        for lang, t in zip(b.column(0), b.column(1), strict=True):
            by.setdefault(lang.as_py(), []).append(trigram_hashes(t.as_py() or ""))
        for lang, parts in by.items():
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), lang, np.int32)), pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))],
                                             ["lang", "gram", "n"])


def _sample(docs: DataFrame, per_language: int, id_col: str, text_col: str, lang_col: str) -> tuple[tuple, DataFrame | None]:
    """Languages, and a stable pseudo-random share of about ``per_language`` rows of each: lang (its number), text."""
    known = (docs.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).cast("string").alias("text"))
             .filter(F.col("_lang").isNotNull()).filter(learning_rows("_id")))
    totals = {r["_lang"]: r["n"] for r in known.groupBy("_lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(totals) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    languages = tuple(sorted(totals))
    if not languages:
        return (), None
    share, number = F.lit(0.0), F.lit(0)
    for k, lang in enumerate(languages):
        share = F.when(F.col("_lang") == lang, min(1.0, per_language / totals[lang])).otherwise(share)
        number = F.when(F.col("_lang") == lang, k).otherwise(number)
    return languages, known.filter(stable_share("_id", 7) < share).select(number.alias("lang"), "text")


def learn_filters(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple:
    """(languages, grams) from the rows that may be learned from and have a language.

    Of each language a stable pseudo-random share of about ``per_language`` rows is
    taken. Without such rows no language is known. More than 64 languages are an error.
    """
    languages, sample = _sample(docs, per_language, id_col, text_col, lang_col)
    if sample is None:
        return (), []
    counts = landed(sample.mapInArrow(tidied(_count_grams), "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "trigrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    # At most 1 / SHARE trigrams of each language.
    grams = counts.join(F.broadcast(totals), "lang").filter(F.col("n") >= SHARE * F.col("total")).select("lang", "gram").collect()
    return languages, sorted((r["lang"], r["gram"]) for r in grams)


def _filters(languages: tuple, grams: bytes) -> Filters:
    return held(("languages", languages, grams), lambda: Filters(languages, [tuple(x) for x in np.frombuffer(grams, np.int64).reshape(-1, 2).tolist()]))


def _predict(batches: Iterator[pa.RecordBatch], languages: tuple, grams: bytes) -> Iterator[pa.RecordBatch]:
    filters = _filters(languages, grams)
    for b in batches:
        got = [filters.predict(t.as_py()) for t in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())],
                                         ["doc_id", "lang_pred", "score"])


def identify_languages(docs: DataFrame, model: tuple, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row, from the text alone. Null texts and texts without a
    letter are ``und`` with score 0; repeated rows get equal results; an empty table gives no rows."""
    languages, grams = model
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(_predict, languages=languages, grams=np.array(grams, np.int64).tobytes()), "doc_id long, lang_pred string, score double")


def _coverages(batches: Iterator[pa.RecordBatch], languages: tuple, grams: bytes) -> Iterator[pa.RecordBatch]:
    """Of each text the share of trigrams that every language contains."""
    filters = _filters(languages, grams)
    for b in batches:
        rows = []
        for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            hashes = trigram_hashes(t or "")
            if len(hashes):
                rows += [(k, k == lang, float(x)) for k, x in enumerate(filters.hits(hashes) / len(hashes))]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.bool_(), pa.float64()), strict=True)], ["lang", "own", "share"])


def learn_floors(docs: DataFrame, model: tuple, per_language: int = SAMPLE_PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang") -> tuple[float, ...]:
    """Least coverage of a text in each language of the model, from the rows that the model was learned from.

    It lies at the geometric mean of what the language covers of its own texts (the lowest
    hundredth left aside) and of texts in the other languages (the highest left aside); a
    lone language asks for half of the former. So it does not depend on the number of languages.
    """
    languages, grams = model
    found, sample = _sample(docs, per_language, id_col, text_col, lang_col)
    if sample is None or not languages:
        return (0.0,) * len(languages)
    if found != languages:
        raise ValueError("the model was learned from other languages")
    shares = sample.mapInArrow(tidied(_coverages, languages=languages, grams=np.array(grams, np.int64).tobytes()), "lang int, own boolean, share double")
    got = {r["lang"]: r for r in shares.groupBy("lang").agg(
        F.percentile_approx(F.when(F.col("own"), F.col("share")), 0.01).alias("own"),
        F.percentile_approx(F.when(~F.col("own"), F.col("share")), 0.99).alias("other")).collect()}

    def floor(r) -> float:
        if r is None or r["own"] is None:
            return 0.0
        return r["own"] / 2 if r["other"] is None else math.sqrt(r["own"] * min(r["own"], r["other"]))
    return tuple(floor(got.get(k)) for k in range(len(languages)))


def _is_in(covered: tuple[int, float, int], floors: tuple[float, ...]) -> bool:
    """Whether a text's coverage is at its language's floor, or within two standard errors of so few trigrams."""
    lang, share, n = covered
    if share <= 0:
        return False
    floor = floors[lang]
    return share >= floor - 2 * math.sqrt(floor * (1 - floor) / n)


def _keep(batches: Iterator[pa.RecordBatch], at: int, languages: tuple, grams: bytes, floors: tuple[float, ...]) -> Iterator[pa.RecordBatch]:
    filters = _filters(languages, grams)
    for b in batches:
        yield b.filter(pa.array([_is_in(filters.covered(t.as_py()), floors) for t in b.column(at)], pa.bool_()))


def keep_identified(docs: DataFrame, model: tuple, floors: tuple[float, ...] | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is in a learned language: the language with the most hits covers
    at least its floor of the text's trigrams (``learn_floors``; without floors one hit is enough)."""
    languages, grams = model
    keep = tidied(_keep, at=docs.columns.index(text_col), languages=languages, grams=np.array(grams, np.int64).tobytes(),
                   floors=(0.0,) * len(languages) if floors is None else floors)
    return rows_kept(docs, keep)
