"""Byte-level BPE encoding and decoding; merges by a segment tree over byte positions.

Each leaf holds the rank of the pair that starts at its byte, each inner node the
leftmost smallest rank below it. A merge updates the leaves of the merged part, of its
live left neighbour and of the part that vanished: three logarithmic point updates.
Matches of the split pattern are encoded separately. The short ones of a group of texts
that no earlier text had are merged together: their trees, of equal size, are rows of one
array, and each step makes one merge and its point updates in every row. Long ones have a
tree of their own. Each worker remembers the ids of the matches it has seen, up to a bound.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import held, tidied

#: Matches that a worker remembers before it starts anew, the bytes of the longest one that is
#: remembered and merged together with others, and the characters of texts that are encoded together.
REMEMBERED, SHORT, TOGETHER = 300_000, 64, 1 << 21


def load_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a ``.tiktoken`` file: a line holds base64 bytes and the rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one match: the leftmost pair of smallest rank merges until no pair has a rank."""
    if not piece:
        return []
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    none = 1 << 62
    after = list(range(1, n + 1))  # where the part at i ends, which is where its right neighbour starts
    ahead = list(range(-1, n - 1))  # where its left neighbour starts
    tree = [none] * (2 * size)
    for i in range(n - 1):
        r = ranks.get(piece[i:i + 2])
        if r is not None:
            tree[size + i] = r * size + i  # rank first, then place: ties go left
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a <= b else b

    def put(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            least = a if a <= b else b
            if tree[k] == least:
                break
            tree[k] = least
            k >>= 1

    def pair(i: int) -> int:
        j = after[i]
        if j >= n:
            return none
        r = ranks.get(piece[i:after[j]])
        return none if r is None else r * size + i

    while (best := tree[1]) != none:
        i = best % size
        j = after[i]
        after[i] = after[j]
        if after[i] < n:
            ahead[after[i]] = i
        put(j, none)
        put(i, pair(i))
        if ahead[i] >= 0:
            put(ahead[i], pair(ahead[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class Merges:
    """Merges many short pieces at a time, over tables of the vocabulary's pairs."""

    _NONE = np.int64(1) << 62

    def __init__(self, ranks: dict[bytes, int]) -> None:
        # A pair's rank by the ids of its halves. Parts are tokens themselves, so every pair that can merge is here.
        keys, values = [], []
        for token, r in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(r)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys, self.values = np.append(np.array(keys, np.int64)[order], self._NONE), np.append(np.array(values, np.int64)[order], 0)
        self.byte_ids = np.array([ranks.get(bytes([b]), 0) for b in range(256)], np.int64)

    def _leaf(self, a: np.ndarray, b: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
        """Rank first, then place, of the pairs (a, b): ties go left. The largest value where there is no such token."""
        key = a << 32 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at] * size + place, self._NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece of 1 to ``SHORT`` bytes, as little-endian bytes."""
        lengths = np.array([len(p) for p in pieces])
        out: list[bytes] = [b""] * len(pieces)
        size = 2
        while size <= SHORT:
            mine = np.flatnonzero((lengths <= size) & ((lengths > size // 2) | (size == 2)))
            for start in range(0, len(mine), 1 << 15):  # bounded arrays
                part = mine[start:start + (1 << 15)]
                for k, ids in zip(part.tolist(), self._rows([pieces[x] for x in part.tolist()], lengths[part], size), strict=True):
                    out[k] = ids
            size *= 2
        return out

    def _rows(self, pieces: list[bytes], n: np.ndarray, size: int) -> list[bytes]:
        m = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(size + 1, b"\0") for p in pieces), np.uint8).reshape(m, size + 1)
        ids = self.byte_ids[raw]
        places = np.arange(size)
        after, ahead = np.tile(np.arange(1, size + 3), (m, 1)), np.tile(np.arange(-1, size + 1), (m, 1))
        tree = np.full((m, 2 * size), self._NONE)
        tree[:, size:] = np.where(places + 1 < n[:, None], self._leaf(ids[:, :-1], ids[:, 1:], places, size), self._NONE)
        width = size
        while width > 1:
            width //= 2
            np.minimum(tree[:, 2 * width:4 * width:2], tree[:, 2 * width + 1:4 * width:2], out=tree[:, width:2 * width])
        live = np.ones((m, size), bool)
        rows = np.arange(m)
        while len(rows := rows[tree[rows, 1] != self._NONE]):
            best = tree[rows, 1]
            i = best % size
            j = after[rows, i]
            k = after[rows, j]
            merged = best // size
            ids[rows, i] = merged
            live[rows, j] = False
            after[rows, i] = k
            ahead[rows, k] = i
            before = ahead[rows, i]
            left, right = before >= 0, k < n[rows]
            here = np.where(right, self._leaf(merged, ids[rows, np.minimum(k, size)], i, size), self._NONE)
            there = np.where(left, self._leaf(ids[rows, before], merged, before, size), self._NONE)
            for at, value, some in ((j, self._NONE, slice(None)), (i, here, slice(None)), (before[left], there[left], left)):
                r, node = rows[some], at + size
                tree[r, node] = value
                while len(node) and node[0] > 1:  # every row's node is on the same level
                    node = node >> 1
                    tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
        live &= places < n[:, None]
        flat = ids[:, :size][live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(1)) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


# The split pattern of the public vocabularies, spelled out for texts of ordinary Latin characters, where the standard
# library's engine finds the same matches at twice the speed; other texts and other patterns take the general engine.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTERS, _DIGITS, _BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾", r"\t\n\r "
_PLAIN = re.compile(r"[\t\n\r -~¡-¬®-ſ]*").fullmatch
_LATIN = re.compile(rf" ?[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[{_DIGITS}]+| ?[^{_BLANKS}{_LETTERS}{_DIGITS}]+"
                    rf"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+").findall


class Encoder(dict):
    """Ids of a match as little-endian bytes, remembered by match."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        super().__init__()
        self.ranks, self.findall, self.latin = ranks, regex.compile(pattern).findall, pattern == PATTERN
        self.merges = Merges(ranks)
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, r in ranks.items():
            self.pieces[r] = piece

    def _matches(self, text: str) -> list[str]:
        return _LATIN(text) if self.latin and _PLAIN(text) else self.findall(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian bytes."""
        found = [self._matches(t) for t in texts]
        new = set().union(*found).difference(self)
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = set().union(*found)
        short, long = [], []
        for x in new:
            if len(piece := x.encode()) > SHORT:
                long.append(x)
                self[x] = np.array(merge_piece(piece, self.ranks), "<u4").tobytes()
            elif (whole := self.ranks.get(piece)) is not None:
                self[x] = whole.to_bytes(4, "little")
            else:
                short.append((x, piece))
        self.update(zip([x for x, _ in short], self.merges.merge([p for _, p in short]), strict=True))
        out = [b"".join(map(self.__getitem__, m)) for m in found]
        for x in long:
            del self[x]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _together(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of about ``TOGETHER`` characters; a longer text alone."""
    start, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > TOGETHER:
            yield texts[start:k]
            start, size = k, 0
        size += len(t)
    yield texts[start:]


def _encoder(content: bytes, pattern: str) -> Encoder:
    return held(("bpe", content, pattern), lambda: Encoder(load_ranks(content), pattern))


def _encode(batches: Iterator[pa.RecordBatch], content: bytes, pattern: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(content, pattern)
    for b in batches:
        n, shas, backs, kept = [], [], [], []
        for group in _together([t or "" for t in b.column(1).to_pylist()]):
            for ids in encoder.encode_all(group):
                n.append(len(ids) // 4)
                shas.append(hashlib.sha256(ids).hexdigest())
                backs.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                if with_ids:
                    kept.append(ids)
        columns = [b.column(0), pa.array(n, pa.int64()), pa.array(shas, pa.string()), pa.array(backs, pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * with_ids, names + ["ids"] * with_ids)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ``ids``: little-endian unsigned 32-bit) of every row.

    Null and empty texts have no ids and the digests of no bytes; repeated rows give
    equal results; an empty table gives no rows. The ranks file (a fixed vocabulary,
    under a megabyte) is read by the driver and sent with the tasks. One scan, no shuffle.
    """
    with open(ranks_path, "rb") as f:
        content = f.read()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return rows.mapInArrow(tidied(_encode, content=content, pattern=pattern, with_ids=with_ids), schema)


def _decode(batches: Iterator[pa.RecordBatch], content: bytes, pattern: str) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(content, pattern)
    for b in batches:
        texts = [encoder.decode(x.as_py() or b"").decode("utf-8", "replace") for x in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ``ids`` (null ids: an empty text)."""
    with open(ranks_path, "rb") as f:
        content = f.read()
    return encoded.select("doc_id", "ids").mapInArrow(tidied(_decode, content=content, pattern=pattern), "doc_id long, text string")
