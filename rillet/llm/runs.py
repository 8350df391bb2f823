"""Periodic runs of words, by string synchronising sets.

Words become numbers, and windows of 1, 2, 4, ... words get equal hashes exactly where
they are equal. At a scale of t words a position is synchronising if, of the windows of t
words that start in its t + 1 positions from here on, the smallest hash belongs to the
first or the last. Windows inside regions of period t / 4 or less are left out of that
choice. So the choice depends on the 2 t words from a position alone, every t positions
hold a synchronising one unless they lie in such a region, and there are O(n / t).

A run of period q repeats at least four times. At the scale t <= q < 2 t it holds a
synchronising position among its first t, the position q further on has the same 2 t words
and so is synchronising too, and no position between has the same words: neighbours with
equal contexts, t to 2 t apart, propose every such period. Periods under the first scale
are found as highly periodic regions of their own, by comparing words with those 1 to 7
places on; regions found at lower scales are what higher scales leave out. Proposals are
extended over the words themselves, so hashes decide nothing.

Texts of a batch are laid one after the other, each closed by a number of its own, which no
period crosses.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import tidied

#: First scale of synchronising sets; a power of two, at least 8.
FIRST_SCALE = 8
#: A run has at least so many words, and so many times its period.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: Text bytes that are searched together; a longer text is searched alone.
GROUP_BYTES = 1 << 20

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_TOP = np.uint64(np.iinfo(np.uint64).max)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ahead(x: np.ndarray, k: int) -> np.ndarray:
    """Values ``k`` places on; beyond the end the last value."""
    return np.concatenate((x[k:], np.repeat(x[-1:], min(k, len(x)))))


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def _small_periods(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) whose period is under the first scale."""
    found = []
    for q in range(1, min(FIRST_SCALE, len(codes))):
        starts, ends = _stretches(codes[q:] == codes[:-q])
        length = ends - starts + q
        long = length >= max(LEAST_WORDS, LEAST_TIMES * q)
        starts, length = starts[long], length[long]
        for d in (d for d in range(1, q) if q % d == 0):  # a smaller period divides q
            at = starts[:, None] + np.arange(q)
            new = (codes[at] != codes[at + d]).any(1)
            starts, length = starts[new], length[new]
        found += zip(starts.tolist(), length.tolist(), [q] * len(starts), strict=True)
    return found


def _extent(codes: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The widest range around ``at`` in which every word equals the one ``q`` places on (at, at if none)."""
    low, high, size = at, at, 64
    while True:
        b = codes[high + q:high + q + size]
        bad = np.flatnonzero(codes[high:high + len(b)] != b)
        if len(bad):
            high += int(bad[0])
            break
        high += len(b)
        if len(b) < size:
            break
        size *= 2
    size = 64
    while low > 0:
        start = max(0, low - size)
        bad = np.flatnonzero(codes[start:low] != codes[start + q:low + q])
        if len(bad):
            low = start + int(bad[-1]) + 1
            break
        low, size = start, 2 * size
    return low, high


def find_runs(codes: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period), by start and period, of number sequences laid end to end.

    ``starts`` are the positions of the sequences' first numbers; the last number of each
    occurs nowhere else. Memory is a fixed number of arrays as long as ``codes``.
    """
    runs = _small_periods(codes)
    lengths = np.diff(np.append(starts, len(codes)))
    origin = np.arange(len(codes))
    ident = _mixed(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    scale = 1
    while len(codes):
        if scale >= FIRST_SCALE:
            long = lengths > LEAST_TIMES * scale
            if not long.all():  # sequences too short for a run of this scale are done
                keep = np.repeat(long, lengths)
                codes, ident, origin, lengths = codes[keep], ident[keep], origin[keep], lengths[long]
                if not len(codes):
                    break
        double = _mixed(ident * np.uint64(0xD6E8FEB86659FD93) + _ahead(ident, scale))
        if scale >= FIRST_SCALE:
            runs += _at_scale(codes, origin, ident, double, scale, runs)
        ident, scale = double, 2 * scale
    return sorted(runs)


def _at_scale(codes: np.ndarray, origin: np.ndarray, ident: np.ndarray, double: np.ndarray, scale: int,
              known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of a period from ``scale`` to under 2 * ``scale``."""
    deep = np.array([r for r in known if r[1] >= scale >= 4 * r[2]], np.int64).reshape(-1, 3)
    at = np.minimum(np.searchsorted(origin, deep[:, 0]), len(origin) - 1)
    here = origin[at] == deep[:, 0]
    marks = np.zeros(len(codes) + 1, np.int64)
    np.add.at(marks, at[here], 1)
    np.add.at(marks, at[here] + deep[here, 1] - scale + 1, -1)
    shown = np.where(np.cumsum(marks[:-1]) > 0, _TOP, ident)
    least, width = shown, 1
    while width < scale:
        least, width = np.minimum(least, _ahead(least, width)), 2 * width
    last = _ahead(shown, scale)
    least = np.minimum(least, last)
    places = np.flatnonzero((least != _TOP) & ((least == shown) | (least == last)))
    context = double[places]
    order = np.argsort(context, kind="stable")
    one, two = places[order[:-1]], places[order[1:]]
    apart = two - one
    fits = (context[order[:-1]] == context[order[1:]]) & (apart >= scale) & (apart < 2 * scale)
    found, seen = [], {}
    for i, q in sorted(zip(one[fits].tolist(), apart[fits].tolist(), strict=True)):
        if i < seen.get(q, 0):
            continue
        low, high = _extent(codes, i, q)
        seen[q] = high
        if high - low + q >= max(LEAST_WORDS, LEAST_TIMES * q):
            found.append((int(origin[low]), high - low + q, q))
    return found


def _words(texts: pa.LargeBinaryArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The words of all texts, one after the other, and the word count of each text. No word is a Python object."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[bounds[0]:bounds[-1]]
    bounds = bounds - bounds[0]
    inside = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    edge = np.zeros(len(data) + 1, bool)  # a word ends where its text ends
    edge[bounds] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    counts = np.diff(np.searchsorted(starts, bounds))
    at = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data[inside])]), counts


def _searched(texts: pa.LargeBinaryArray) -> tuple[np.ndarray, pa.ListArray, pa.LargeBinaryArray]:
    """Word count, runs, and text with the runs collapsed, of each text."""
    words, counts = _words(texts)
    coded = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    size = counts + 1
    starts = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)
    codes = np.empty(len(words) + len(texts), np.int64)
    ends = starts + size - 1
    inside = np.ones(len(codes), bool)
    inside[ends] = False
    codes[inside] = coded
    codes[ends] = len(words) + np.arange(len(texts))
    found = np.array(find_runs(codes, starts), np.int64).reshape(-1, 3)
    first, length, period = found.T
    text = np.searchsorted(starts, first, "right") - 1
    gone = np.zeros(len(codes) + 1, np.int64)
    np.add.at(gone, first + period, 1)
    np.add.at(gone, first + length, -1)
    kept = (np.cumsum(gone[:-1]) == 0)[inside]
    runs = pa.StructArray.from_arrays([first - starts[text], length, period], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32), runs)
    before = np.concatenate(([0], np.cumsum(kept)))[np.concatenate(([0], np.cumsum(counts)))]
    left = pa.LargeListArray.from_arrays(before, words.filter(pa.array(kept)))
    return counts, runs, pc.binary_join(left, pa.scalar(b" ", pa.large_binary()))


def _groups(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """First and end of neighbouring texts that are searched together."""
    start, size = 0, 0
    for k, n in enumerate(lengths):
        if k > start and size + n > GROUP_BYTES:
            yield start, k
            start, size = k, 0
        size += n
    if lengths:
        yield start, len(lengths)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for start, end in _groups(pc.binary_length(b.column(1)).to_pylist()):
            group = b.slice(start, end - start)
            counts, runs, out = _searched(group.column(1).cast(pa.large_binary()))
            yield pa.RecordBatch.from_arrays(
                [group.column(0), pa.array(counts, pa.int64()), runs, out.cast(pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs and collapsed of every row.

    Words are the longest parts of a text without white space (09 to 0D, 20). A run is a
    stretch of words with smallest period q (words q apart are equal), of at least
    ``LEAST_TIMES`` * q and ``LEAST_WORDS`` words, that no word beside it extends with that
    period; runs come by start, then period. ``collapsed`` are the words joined by a blank,
    without those that a run holds after its first q. Null, empty and blank texts have no
    words, no runs and an empty ``collapsed``. Ids may be null or repeat: every row gets a
    row. Other columns are not looked at.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(tidied(_batches), f"doc_id long, n_words long, runs {RUNS}, collapsed string")
