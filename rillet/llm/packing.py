"""Packing of documents into fixed sequences as a cutting-stock problem solved by column generation.

Token lengths are counted in a histogram of 256 classes. A linear program over patterns
(how many pieces of each class share a sequence) is solved on the driver from that
bounded table: a knapsack dynamic program prices new patterns against the duals until
none improves. Rounded down, the patterns are dealt to the pieces by their rank in a
class; the rest, less than one sequence per pattern, is packed first-fit decreasing.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rillet.llm.common import held, landed, numbered, tidied

CAPACITY = 2048
WIDTH = 8  # tokens in a length class
END_ID = 1
REMEMBERED = 300_000

# Texts of these characters are split here and need no normalising but lower case.
_LETTERS = "a-zªµºÀ-ÖØ-öø-ſ"
_PLAIN = re.compile(r"[\t\n\r -~¡-¬®-įı-ſ]*").fullmatch
_SPLIT = re.compile(rf"[{_LETTERS}]+|[0-9²³¹¼-¾]|'(?:s|t|re|ve|m|ll|d)|[^\t\n\r {_LETTERS}0-9²³¹¼-¾]+").findall


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write a byte as a printable character: itself, or one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + k for k, b in enumerate(hidden)}


class WordIds(dict):
    """Ids of a split piece as little-endian bytes, remembered by piece."""

    def __init__(self, content: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = True
        self.model, self.letters = self.tokenizer.model, _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        tokens = self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))
        ids = np.array([t.id for t in tokens], "<u4").tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        if len(piece) < 64:
            self[piece] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The tokenizer's ids; ordinary Latin texts are put together from the ids of their pieces."""
        if not _PLAIN(text):
            return self.whole(text)
        return b"".join(map(self.__getitem__, _SPLIT(text.lower())))


def _word_ids(content: str) -> WordIds:
    return held(("word ids", content), lambda: WordIds(content))


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def _cut(batches: Iterator[pa.RecordBatch], content: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    words = _word_ids(content)
    end = np.array([END_ID], "<u4").tobytes()
    for b in batches:
        out: list[list] = [[] for _ in range(5 + with_ids)]
        for doc, t in zip(b.column(0), b.column(1), strict=True):
            ids = words.encode(t.as_py() or "") + end
            for at in range(0, len(ids), 4 * CAPACITY):
                part = ids[at:at + 4 * CAPACITY]
                row = [doc.as_py(), at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4] + [part] * with_ids
                for column, v in zip(out, row, strict=True):
                    column.append(v)
        kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], _NAMES + ["ids"] * with_ids)


def cut_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Token pieces of at most 2048 ids of every row: whole pieces first, the rest last. No shuffle."""
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = ", ".join(f"{c} long" for c in _NAMES) + ", ids binary" * with_ids
    return rows.mapInArrow(tidied(_cut, content=content, with_ids=with_ids), schema)


def _best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming. Value and counts of the best pattern."""
    worth = np.zeros(capacity + 1)  # by size; a size without pieces is an idle gap
    worth[sizes] = np.maximum(values, 0)
    back = np.zeros(capacity + 1)  # best value of room c, at place capacity - c
    choice = np.zeros(capacity + 1, int)
    for c in range(1, capacity + 1):
        got = back[capacity - c + 1:] + worth[1:c + 1]
        i = got.argmax()
        back[capacity - c], choice[c] = got[i], i + 1
    at = {int(s): k for k, s in enumerate(sizes)}
    counts, c = np.zeros(len(sizes)), capacity
    while c > 0:
        s = int(choice[c])
        if worth[s] > 0:
            counts[at[s]] += 1
        c -= s
    return float(back[0]), counts


def cutting_stock(demand: dict[int, int], capacity: int, gap: float = 5e-4) -> list[tuple[int, dict[int, int]]]:
    """(copies, {size: pieces of it}) patterns that cover the demand exactly; sizes are 1 .. capacity.

    The relaxed program is solved by the revised simplex method with priced columns,
    to within ``gap`` of its bound; copies are rounded down and the rest is packed
    first-fit decreasing, one pattern for each sequence.
    """
    sizes = np.array(sorted(s for s, n in demand.items() if n), int)
    if not len(sizes):
        return []
    d = np.array([demand[int(s)] for s in sizes], float)
    m = len(sizes)
    columns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / (capacity // sizes))
    x = inverse @ d
    bound = sizes @ d / capacity
    for step in range(20 * m + 100):
        duals = inverse.sum(0)
        value, column = _best_pattern(sizes, duals, capacity)
        bound = max(bound, (duals @ d) / value)
        if value <= 1 + 1e-9 or x.sum() * (1 - gap) <= bound:
            break
        move = inverse @ column
        ok = move > 1e-10
        if not ok.any():
            break
        ratio = np.full(m, np.inf)
        ratio[ok] = x[ok] / move[ok]
        r = int(ratio.argmin())
        columns[:, r] = column
        pivot = inverse[r] / move[r]
        inverse -= np.outer(move, pivot)
        inverse[r] = pivot
        x = np.maximum(inverse @ d, 0) if step % 64 else np.maximum(np.linalg.solve(columns, d), 0)
    left = {int(s): int(n) for s, n in zip(sizes, d, strict=True)}
    patterns = []
    for r in np.argsort(-x, kind="stable"):
        counts = {int(s): int(n) for s, n in zip(sizes, columns[:, r], strict=True) if n}
        copies = min([int(x[r] + 1e-9), *(left[s] // n for s, n in counts.items())])
        if copies > 0:
            patterns.append((copies, counts))
            for s, n in counts.items():
                left[s] -= copies * n
    bins: list[Counter] = []
    room: list[int] = []
    for s in sorted(left, reverse=True):
        for _ in range(left[s]):
            at = next((k for k, free in enumerate(room) if free >= s), None)
            if at is None:
                bins.append(Counter())
                room.append(capacity)
                at = len(bins) - 1
            bins[at][s] += 1
            room[at] -= s
    return patterns + [(1, dict(b)) for b in bins]


def allotments(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, end rank, first sequence, pieces a sequence): which ranks of a class a pattern takes."""
    used: Counter = Counter()
    out, sequence = [], 0
    for copies, counts in patterns:
        for s, n in sorted(counts.items()):
            out.append((s, used[s], used[s] + copies * n, sequence, n))
            used[s] += copies * n
        sequence += copies
    return out


def pack_pieces(pieces: DataFrame, width: int = WIDTH) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, start, length, ids_crc32, ...) of at most 2048 ids."""
    spark = pieces.sparkSession
    classed = pieces.withColumn("_class", F.ceil(F.col("length") / width).cast("int"))
    counted = classed.groupBy("_class").agg(F.count("*").alias("n")).collect()  # at most 256 rows
    table = allotments(cutting_stock({r["_class"]: r["n"] for r in counted}, CAPACITY // width))
    # Bounded by the classes: at most 256 patterns of at most 22 sizes, and as many sequences of the rest.
    table = spark.createDataFrame(table, "_class int, _lo long, _hi long, _first long, _per long")
    ranked = numbered(classed, "_class", ["doc_id", "start", "length", "ids_crc32"], "_rank")
    placed = (ranked.join(F.broadcast(table), ["_class"])
              .filter("_rank >= _lo AND _rank < _hi")
              .withColumn("sequence_id", F.col("_first") + F.floor((F.col("_rank") - F.col("_lo")) / F.col("_per")).cast("long")))
    before = Window.partitionBy("sequence_id").orderBy("_class", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
            .drop("_class", "_lo", "_hi", "_first", "_per", "_rank"))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ``ids``), sequence_id, offset of every piece.

    A null or empty text is the single id 1; repeated rows are packed each for itself;
    an empty table gives no rows. Texts are tokenised once, and the pieces land in the
    shared folder for the two passes over them (histogram, ranks).
    """
    pieces = landed(cut_documents(docs, tokenizer_path, id_col, text_col, with_ids), "pieces")
    return pack_pieces(pieces)
