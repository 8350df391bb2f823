"""Quality by weak supervision: rules vote good, bad or abstain; expectation-maximisation weighs them.

The votes of all documents are counted by vote pattern (at most 3 to the number of
rules, so the table is bounded); EM over that table estimates, per rule, how it votes
on good and on bad documents. The posterior of a document then is a sum of log-odds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import landed, let, sliding, words

WINDOW = 8
#: Words of a stretch whose distinct words are counted.
STRETCH = 200
SYMBOLS = "#*$%&|<>"
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BLANKS = " \t\n\x0b\f\r"
RULES = ("words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "digits", "line_ends", "variety", "punctuation")


def _repeat_words(w: Column) -> Column:
    """Words inside 8-word windows that occur twice or more in the text."""
    def covered(h):
        # (hash, place) sorted: a window repeats if a neighbour has its hash.
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s):
            return F.sort_array(F.transform(F.filter(s, lambda v, k: (
                F.coalesce(F.get(s, k - 1)["h"] == v["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == v["h"], F.lit(False)))),
                lambda v: v["i"]))

        def total(p):  # union of [i, i + 8)
            return F.aggregate(F.transform(p, lambda v, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - v, F.lit(WINDOW)))),
                               F.lit(0).cast("long"), lambda a, v: a + v)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(let(placed, places), total))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*sliding(w, WINDOW, i)))
    return F.when(F.size(w) > WINDOW, let(windows, covered)).otherwise(F.lit(0).cast("long"))


def _variety(w: Column) -> Column:
    """Share of distinct words, the mean over whole stretches of ``STRETCH`` words, so that a long text's is no
    smaller for its length; of all words where there is no whole stretch."""
    starts = F.sequence(F.lit(0), F.greatest(F.floor(F.size(w) / STRETCH).cast("int") - 1, F.lit(0)))
    of_each = F.transform(starts, lambda k: F.size(F.array_distinct(F.slice(w, k * STRETCH + 1, F.lit(STRETCH)))))
    distinct = F.aggregate(of_each, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.try_divide(distinct, F.least(F.size(w), F.size(of_each) * STRETCH))


def _removed(text: Column, chars: str) -> Column:
    """Code points of ``chars`` in the text."""
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base and rule measures of every row (null text: empty), one scan, no shuffle."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    lines = F.filter(F.split(text, "\n"), lambda s: F.btrim(s, F.lit(_BLANKS)) != "")

    def of_words(w):
        return F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words"),
                        _variety(w).alias("variety"))

    def of_lines(s):
        return F.struct(F.size(s).cast("long").alias("n_lines"), (F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
                        F.size(F.filter(s, lambda x: F.substring(F.rtrim(x), -1, 1).isin(".", "!", "?", ":", ";", '"', "”", "»"))).cast("long").alias("n_ended"))
    return rows.select(
        "doc_id", let(words(text), of_words).alias("w"), let(lines, of_lines).alias("l"),
        (F.char_length(text).cast("long") - _removed(text, _BLANKS)).alias("word_chars"), _removed(text, SYMBOLS).alias("n_symbols"),
        _removed(text, upper).alias("n_upper"), _removed(text, lower).alias("n_lower"), _removed(text, "0123456789").alias("n_digits"),
        _removed(text, _MARKS).alias("n_marks"),
    ).select("doc_id", "w.*", "l.*", "word_chars", "n_symbols", "n_upper", "n_lower", "n_digits", "n_marks")


def _vote(value: Column, good: Column, bad: Column) -> Column:
    """1 good, 0 bad, -1 abstain (also where the value has no meaning)."""
    return F.when(value.isNull(), -1).when(bad, 0).when(good, 1).otherwise(-1)


def votes() -> dict[str, Column]:
    """One vote per rule from the measures; texts too short for a rule abstain."""
    n = F.col("n_words")
    per_word = lambda c: F.try_divide(F.col(c), n)
    enough = n >= 20
    length, symbols, repeats = per_word("word_chars"), per_word("n_symbols"), F.when(enough, per_word("n_repeat_words"))
    dup = F.when(F.col("n_lines") >= 3, F.try_divide(F.col("n_dup_lines"), F.col("n_lines")))
    capitals = F.try_divide(F.col("n_upper"), F.col("n_upper") + F.col("n_lower"))
    digits = F.try_divide(F.col("n_digits"), F.col("word_chars"))
    marks = F.try_divide(F.col("n_marks"), F.col("word_chars"))
    ended = F.when(F.col("n_lines") >= 3, F.try_divide(F.col("n_ended"), F.col("n_lines")))
    variety = F.when(enough, F.col("variety"))
    return {
        "words": _vote(n, n >= 20, n < 10),
        "word_length": _vote(length, length.between(3.0, 10.0), (length < 2.0) | (length > 16.0)),
        "symbols": _vote(symbols, symbols <= 0.02, symbols > 0.1),
        "dup_lines": _vote(dup, dup <= 0.1, dup > 0.3),
        "repeats": _vote(repeats, repeats <= 0.1, repeats > 0.3),
        "capitals": _vote(capitals, capitals <= 0.2, capitals > 0.5),
        "digits": _vote(digits, digits <= 0.05, digits > 0.2),
        "line_ends": _vote(ended, ended >= 0.5, ended < 0.1),
        "variety": _vote(variety, variety >= 0.3, variety < 0.15),
        "punctuation": _vote(marks, marks <= 0.08, marks > 0.12),
    }


#: Belief before any document: how often a rule votes bad on a bad and on a good document, worth this share of all documents.
BAD_ON_BAD, BAD_ON_GOOD, BELIEF = 0.2, 0.01, 0.005


def fit_votes(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 60) -> tuple[float, list[dict[int, float]]]:
    """EM over (pattern, count): prior log-odds of good, and per rule the log-odds of each vote.

    The first guess is the verdict of an all-must-pass filter, held with some doubt;
    EM then learns which rules agree with the others and weighs each vote by that. A
    belief worth half a percent of the documents keeps the two classes from swapping.
    """
    if not patterns:
        return 0.0, []
    rules, total = len(patterns[0][0]), sum(n for _, n in patterns)
    weight = max(1.0, BELIEF * total)
    guess = [0.1 if 0 in pattern else 0.99 for pattern, _ in patterns]
    for _ in range(rounds):
        good = [[weight * (1 - BAD_ON_GOOD), weight * BAD_ON_GOOD] for _ in range(rules)]  # votes 1, 0 by good documents
        bad = [[weight * (1 - BAD_ON_BAD), weight * BAD_ON_BAD] for _ in range(rules)]
        mass = 0.0
        for (pattern, n), p in zip(patterns, guess, strict=True):
            mass += n * p
            for r, v in enumerate(pattern):
                if v >= 0:
                    good[r][1 - v] += n * p
                    bad[r][1 - v] += n * (1 - p)
        share = (mass + 0.9 * weight) / (total + weight)
        # A vote never speaks against its own direction: an uninformative rule weighs nothing.
        logs = [{1: max(0.0, math.log(g[0] / sum(g) * sum(b) / b[0])), 0: min(0.0, math.log(g[1] / sum(g) * sum(b) / b[1]))}
                for g, b in zip(good, bad, strict=True)]
        prior = math.log(share / (1 - share))
        odds = [prior + sum(logs[r][v] for r, v in enumerate(pattern) if v >= 0) for pattern, _ in patterns]
        guess = [1 / (1 + math.exp(-max(-500.0, min(500.0, o)))) for o in odds]
    return prior, logs


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.5) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality.

    Null and blank texts have no words: the base rule fails them. Repeated rows are
    judged alike; an empty table gives no rows. ``quality`` is the posterior
    probability that a document is good; ``kept`` needs ``keep_at`` of it and the base rule.
    """
    seen = landed(measures(docs, id_col, text_col), "quality")
    vote = votes()
    names = list(vote)
    counted = seen.select(*[c.alias(k) for k, c in vote.items()]).groupBy(*names).agg(F.count("*").alias("n"))
    prior, logs = fit_votes([(tuple(r[k] for k in names), r["n"]) for r in counted.sort(*names).collect()])  # at most 3^10 rows
    odds = F.lit(prior)
    for k, weights in zip(names, logs, strict=False):
        odds = odds + F.when(vote[k] == 1, weights[1]).when(vote[k] == 0, weights[0]).otherwise(0.0)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    quality = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
    return seen.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & (quality >= keep_at)).alias("kept"), quality.alias("quality"))
