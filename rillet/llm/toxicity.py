"""Toxicity by a weighted lexicon: Aho-Corasick over folded words, normalised by length, with exception phrases.

Folding lower-cases, maps look-alike letters of other scripts to Latin ones, and digits
and signs inside words to the letters they stand for. The lexicon (words and word
beginnings, weighted by log-odds) and the exception phrases (word pairs in
which a lexicon word is harmless) are learned from a bounded sample of labelled rows;
so is the logistic curve from weight and density to the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import held, landed, learning_rows, rows_kept, stable_share, tidied

#: Labelled rows to learn from, about so many per class at most.
SAMPLE_PER_CLASS = 8_000
#: Lexicon terms and exception phrases kept at most, the heaviest first.
TERMS, PHRASES = 5_000, 1_000
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7

# Look-alike letters and the Latin letters they are read as.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ո": "n", "ս": "u",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ｏ": "o",
}
# Digits and signs used as letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
_FOLD = str.maketrans(HOMOGLYPHS)
_UNLEET = str.maketrans(LEET)
_STRANGE = re.compile("[" + "".join(HOMOGLYPHS) + "Ａ-ｚ​-‍­]")
_HIDDEN = re.compile("[​-‍­]")
_WIDE = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}
_WORD = re.compile(r"[^\W_]+")
_LEETED = re.compile(r"(?=[\w@$]*[^\W\d_])(?=[\w@$]*[0134578@$])[\w@$]+")


def fold(text: str) -> list[str]:
    """Folded words of a text."""
    text = text.lower()
    if _STRANGE.search(text):
        text = _HIDDEN.sub("", text).translate(_WIDE).lower().translate(_FOLD)
    if not text.isascii() or any(c in text for c in LEET):
        text = _LEETED.sub(lambda m: m[0].translate(_UNLEET), text)
    return _WORD.findall(text)


def _terms(words: set[str]) -> set[str]:
    """`` word `` and `` beginning`` patterns of a document; both open with a blank."""
    out = {f" {w} " for w in words if len(w) >= 3}
    for w in words:
        out.update(f" {w[:k]}" for k in PREFIXES if len(w) > k)
    return out


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        toxic, clean = Counter(), Counter()
        for t, y in zip(b.column(0), b.column(1), strict=True):
            (toxic if y.as_py() else clean).update(_terms(set(fold(t.as_py() or ""))))
        keys = [k for k in clean.keys() | toxic.keys()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()),
                                          pa.array([clean[k] for k in keys], pa.int64())], ["term", "toxic", "clean"])


class Lexicon:
    """Weighted terms, exception phrases and the curve from weight and density to a score."""

    def __init__(self, terms: dict[str, float], phrases: list[str], curve: tuple[float, float, float]) -> None:
        self.terms, self.phrases, self.curve = terms, phrases, curve
        self.found = ahocorasick.Automaton()
        for t, w in terms.items():
            self.found.add_word(t, (len(t), w))
        for p in phrases:
            self.found.add_word(f" {p} ", (len(p) + 2, None))
        self.found.make_automaton()
        self.any = bool(terms)

    def hits(self, words: list[str]) -> dict[int, float]:
        """Heaviest term at each place of the joined text that no exception phrase covers."""
        if not self.any or not words:
            return {}
        at: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (n, w) in self.found.iter(f" {' '.join(words)} "):
            start = end - n + 1
            if w is None:
                spared.append((start, end))
            elif w > at.get(start, 0.0):
                at[start] = w
        if not spared or not at:
            return at
        spared.sort()
        kept, k, until = {}, 0, -1
        for place in sorted(at):
            while k < len(spared) and spared[k][0] <= place:
                until, k = max(until, spared[k][1]), k + 1
            if place >= until:
                kept[place] = at[place]
        return kept

    def features(self, words: list[str]) -> tuple[float, float]:
        """Logarithms of the weight of the distinct words that hit, and of its share of all distinct words."""
        text, best = f" {' '.join(words)} ", {}
        for at, w in self.hits(words).items():
            best[text[at:text.find(" ", at + 1)]] = w
        weight = sum(best.values())
        return math.log1p(weight), math.log1p(100 * weight / len(set(words))) if words else 0.0

    def score(self, text: str) -> float:
        x, y = self.features(fold(text))
        z = self.curve[0] + self.curve[1] * x + self.curve[2] * y
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Logistic regression by Newton's method; a small ridge keeps separable samples finite."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(3), x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1]), float(beta[2])


def _pairs(batches: Iterator[pa.RecordBatch], terms: dict[str, float]) -> Iterator[pa.RecordBatch]:
    """Word pairs around lexicon hits, counted by the documents' class."""
    lexicon = Lexicon(terms, [], (0.0, 0.0, 0.0))
    for b in batches:
        counts = (Counter(), Counter())
        for t, y in zip(b.column(0), b.column(1), strict=True):
            words = fold(t.as_py() or "")
            places, at = lexicon.hits(words), 0
            near = set()
            for i, w in enumerate(words):
                if at in places:
                    near.update({" ".join(words[max(0, i - 1):i + 1]), " ".join(words[i:i + 2])} if len(words) > 1 else ())
                at += len(w) + 1
            counts[bool(y.as_py())].update(p for p in near if " " in p)
        keys = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([counts[1][k] for k in keys], pa.int64()),
                                          pa.array([counts[0][k] for k in keys], pa.int64())], ["term", "toxic", "clean"])


def _measured(batches: Iterator[pa.RecordBatch], terms: dict[str, float], phrases: list[str]) -> Iterator[pa.RecordBatch]:
    lexicon = Lexicon(terms, phrases, (0.0, 0.0, 0.0))
    for b in batches:
        got = [lexicon.features(fold(t.as_py() or "")) for t in b.column(0)]
        yield pa.RecordBatch.from_arrays([b.column(1), pa.array([x for x, _ in got], pa.float64()), pa.array([y for _, y in got], pa.float64())],
                                         ["toxic", "x", "y"])


def learn_lexicon(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> tuple:
    """(terms, phrases, curve) from the labelled rows that may be learned from.

    Of larger label tables a stable pseudo-random share of each class is taken, about
    ``per_class`` rows. A label of null is none; a document with several labels is toxic
    if one says so. Without labels, or without both classes, nothing is learned and every
    score is the share of toxic labels (0 without labels).
    """
    known = (labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
             .filter(F.col("_toxic").isNotNull() & F.col("_id").isNotNull()).filter(learning_rows("_id"))
             .groupBy("_id").agg(F.max(F.when(F.col("_toxic") > 0, 1).otherwise(0)).alias("_toxic")))
    totals = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(totals) < 2:
        rate = 0.999 if totals.get(1) else 0.001
        return {}, [], (math.log(rate / (1 - rate)), 0.0, 0.0)
    share = F.when(F.col("_toxic") == 1, min(1.0, per_class / totals[1])).otherwise(min(1.0, per_class / totals[0]))
    # At most about 2 x per_class ids: a bounded table.
    picked = F.broadcast(known.filter(stable_share("_id", 5) < share))
    sample = landed(docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(picked, "_id")
                    .select("text", F.col("_toxic").alias("toxic")), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    counted = (sample.mapInArrow(tidied(_count_terms), "term string, toxic long, clean long")
               .groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")))
    # A term is taken by the lower end of its log-odds, two standard errors down, and weighs the log-odds.
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("c") + 0.5) / (n_clean + 1))
    doubt = 2 * F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    top = (counted.filter("t >= 4").withColumn("w", odds).filter(F.col("w") - doubt > 1.2)
           .orderBy(F.desc("w"), "term").limit(TERMS).select("term", "w").collect())
    terms = {r["term"]: float(r["w"]) for r in top}
    around = (sample.mapInArrow(tidied(_pairs, terms=terms), "term string, toxic long, clean long")
              .groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")))
    spared = (around.filter((F.col("c") >= 3) & (F.col("c") / max(n_clean, 1) > 4 * F.col("t") / max(n_toxic, 1)))
              .orderBy(F.desc("c"), "term").limit(PHRASES).select("term").collect())
    phrases = [r["term"] for r in spared]
    rows = sample.mapInArrow(tidied(_measured, terms=terms, phrases=phrases), "toxic int, x double, y double").collect()  # the bounded sample, 3 numbers a row
    return terms, phrases, _curve(np.array([(r["x"], r["y"]) for r in rows]), np.array([r["toxic"] for r in rows], float))


def _ready(terms: tuple, phrases: tuple, curve: tuple) -> Lexicon:
    return held(("lexicon", terms, phrases, curve), lambda: Lexicon(dict(terms), list(phrases), curve))


def _score(batches: Iterator[pa.RecordBatch], terms: tuple, phrases: tuple, curve: tuple) -> Iterator[pa.RecordBatch]:
    lexicon = _ready(terms, phrases, curve)
    for b in batches:
        scores = [lexicon.score(t.as_py() or "") for t in b.column(b.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())], ["doc_id", "score"])


def score_toxicity(docs: DataFrame, model: tuple, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row, from the text alone. Null and empty texts score
    as texts without hits; repeated rows score alike; an empty table gives no rows."""
    terms, phrases, curve = model
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(_score, terms=tuple(sorted(terms.items())), phrases=tuple(phrases), curve=curve), "doc_id long, score double")


def _keep(batches: Iterator[pa.RecordBatch], at: int, terms: tuple, phrases: tuple, curve: tuple, threshold: float) -> Iterator[pa.RecordBatch]:
    lexicon = _ready(terms, phrases, curve)
    for b in batches:
        yield b.filter(pa.array([lexicon.score(t.as_py() or "") < threshold for t in b.column(at)], pa.bool_()))


def drop_toxic(docs: DataFrame, model: tuple, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score under ``threshold``."""
    terms, phrases, curve = model
    keep = tidied(_keep, at=docs.columns.index(text_col), terms=tuple(sorted(terms.items())), phrases=tuple(phrases), curve=curve, threshold=threshold)
    return rows_kept(docs, keep)
