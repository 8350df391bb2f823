"""Licence scans: Aho-Corasick over the words of a text, and a shunting-yard parser for licence expressions.

A text becomes its lower-cased words joined by single blanks, so one automaton finds
notice phrases as consecutive words. Identifier tags (``SPDX-License-Identifier: ...``)
are found by the same automaton as the words ``spdx license identifier``; the expression
behind a tag is then parsed from the raw text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notice phrases beyond the base ones, with their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl", "mozilla public license": "mpl",
    "eclipse public license": "epl", "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc", "boost software license": "bsl", "the unlicense": "unlicense", "cc0": "cc0", "public domain": "public-domain",
    "creative commons": "cc", "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "all rights reserved": "reserved",
    "permission is hereby granted free of charge": "mit",
}
TAG = "spdx license identifier"
#: Families whose terms ask little of the user, and those that bind copies or forbid use.
PERMISSIVE = {"apache", "mit", "bsd", "isc", "bsl", "unlicense", "cc0", "public-domain", "cc-by", "cc"}
RESTRICTED = {"reserved": 0.0, "cc-by-nc": 0.1, "cc-by-nd": 0.2, "agpl": 0.3, "gpl": 0.4, "cc-by-sa": 0.5, "lgpl": 0.6, "mpl": 0.7, "epl": 0.7}
_STRENGTH = {"with": 3, "and": 2, "or": 1}
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_EXPRESSION = re.compile(r"(?i)spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)")


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, TAG}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def family(name: str) -> str:
    """Label of a licence identifier: its leading family, else the identifier in lower case."""
    low = name.lower().rstrip("+")
    for k in sorted({*PERMISSIVE, *RESTRICTED}, key=lambda k: (-len(k), k)):
        if low == k or low.startswith(k + "-"):
            return k
    return low


def parse_expression(text: str) -> list:
    """Postfix form of a licence expression by the shunting-yard method.

    ``with`` binds tighter than ``and``, ``and`` tighter than ``or``; all are read from
    the left. Raises ValueError where names, operators and brackets do not fit together;
    reading stops before the first word that can no longer belong to the expression.
    """
    out, waiting, name_next = [], [], True
    for m in _TOKEN.finditer(text):
        token, low = m[0], m[0].lower()
        if token == "(":
            if not name_next:
                break
            waiting.append(token)
        elif token == ")":
            if name_next:
                raise ValueError("a name is missing before )")
            if "(" not in waiting:
                break
            while (op := waiting.pop()) != "(":
                out.append(op)
        elif low in _STRENGTH:
            if name_next:
                raise ValueError(f"a name is missing before {low}")
            while waiting and waiting[-1] != "(" and _STRENGTH[waiting[-1]] >= _STRENGTH[low]:
                out.append(waiting.pop())
            waiting.append(low)
            name_next = True
        else:
            if not name_next:
                break
            out.append(("name", token))
            name_next = False
    if name_next or "(" in waiting:
        raise ValueError("the expression breaks off")
    return out + waiting[::-1]


def evaluate(postfix: list, freedom=None) -> tuple[set[str], float]:
    """Labels named by an expression and its freedom: ``or`` lets the user choose the freer side,
    ``and`` binds to the stricter, ``with`` adds an exception and keeps the licence."""
    freedom = freedom or free_of
    stack: list[tuple[set[str], float]] = []
    for x in postfix:
        if isinstance(x, tuple):
            label = family(x[1])
            stack.append(({label}, freedom(label)))
            continue
        (b, fb), (a, fa) = stack.pop(), stack.pop()
        stack.append((a, fa) if x == "with" else (a | b, max(fa, fb) if x == "or" else min(fa, fb)))
    return stack[-1]


def free_of(label: str) -> float:
    return RESTRICTED.get(label, 1.0 if label in PERMISSIVE else 0.5)


def scan_text(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, spans of one text.

    ``score`` is the freedom of the strictest licence found (0 reserved to 1 permissive), 1
    where none is found: the least of all notices, base phrases and expressions, of which
    each counts as a whole (``or`` leaves the choice). ``spans`` lists (first word, phrase) of every notice.
    """
    text = text or ""
    found = WORD.findall(text.translate(_LOWER))
    if not found:
        return 0, 0, None, None, "", "", 1.0, [], []
    joined = " " + " ".join(found) + " "
    base, noticed, labels, spans, score, at, seen = set(), set(), set(), [], 1.0, 0, 0
    starts, n_base, tagged = [], 0, False
    for end, phrase in _automaton().iter(joined):
        start = end - len(phrase) - 1  # the blank before the first word
        spans.append((start, phrase))
    spans.sort()
    placed = []
    for start, phrase in spans:
        seen += joined.count(" ", at, start)
        at = start
        placed.append((seen, phrase))
        if phrase in BASE:
            n_base += 1
            starts.append(seen)
            base.add(BASE[phrase])
        elif phrase == TAG:
            tagged = True
        else:
            noticed.add(NOTICES[phrase])
    expressions = []
    for m in _EXPRESSION.finditer(text) if tagged else ():
        try:
            named, free = evaluate(parse_expression(m[1]))
        except ValueError:
            continue
        expressions.append(m[1].strip())
        labels |= named
        score = min(score, free)
    labels |= noticed
    score = min([score, *map(free_of, base | noticed)])
    return (len(found), n_base, min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), float(score), expressions, placed)


_SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
           "score double, expressions array<string>, spans array<struct<word:long,phrase:string>>")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string()), pa.list_(pa.struct([("word", pa.int64()), ("phrase", pa.string())]))]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "spans"]
    for b in batches:
        columns: list[list] = [[] for _ in kinds]
        for t in b.column(1):  # one text at a time
            for out, v in zip(columns, scan_text(t.as_py()), strict=True):
                out.append(v)
        columns[-1] = [[{"word": w, "phrase": p} for w, p in s] for s in columns[-1]]
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", *names])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence notices of every row. Null and empty texts have no words, no labels and score 1;
    repeated rows give equal results; an empty table gives no rows. One scan, no shuffle."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan, _SCHEMA)
