"""HTML pages -> structured rows with native regex expressions.

Patterns are parameters: a page shape that changes needs a new pattern, not
new code. Everything runs as Catalyst expressions on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINK_BLOCK = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def extract_blocks(df: DataFrame, html: str, pattern: str, fields: dict[str, int],
                   keep: list[str] | tuple = ()) -> DataFrame:
    """One row per match of ``pattern`` in each page; ``fields`` names the
    capture groups. Pages without a match give no rows."""
    arrays = {name: F.regexp_extract_all(F.col(html), F.lit(pattern), idx) for name, idx in fields.items()}
    zipped = F.arrays_zip(*[a.alias(n) for n, a in arrays.items()])
    return df.select(*keep, F.posexplode(zipped).alias("pos", "_b")).select(*keep, "pos", "_b.*")


def capture(html: Column | str, pattern: str, group: int = 1) -> Column:
    """One group of the first match of ``pattern``; NULL where nothing matches."""
    h = F.col(html) if isinstance(html, str) else html
    return F.when(h.rlike(pattern), F.regexp_extract(h, pattern, group))


#: Parts the captured fields of one match; a control character that markup cannot hold.
_SEPARATOR = "\x1f"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def element(css_class: str, name: str) -> str:
    """Pattern of the first element of a class; group ``name`` is its content after a ``>``."""
    return rf"""<(?<{name}Tag>\w+)\b[^>]*\bclass=["'][^"']*\b{css_class}\b[^"']*["'][^>]*(?<{name}>>.*?)</\k<{name}Tag>>"""


def captures(text: Column, patterns: Sequence[str], names: Sequence[str]) -> Column:
    """Struct of the named groups of several patterns, all taken by one match.

    Each pattern is looked for on its own from the start of the text (``.*?`` before it
    finds its first place, ``.*`` its last); groups of a pattern that is not in the text
    are empty. The text is scanned by one expression that is evaluated once, so nothing is
    tested first and extracted again.
    """
    whole = "(?s)^" + "".join(f"(?:(?={p}))?" for p in patterns) + ".*$"
    clean = F.when(F.contains(text, F.lit(_SEPARATOR)), F.replace(text, F.lit(_SEPARATOR), F.lit(""))).otherwise(text)
    parts = F.split(F.regexp_replace(clean, whole, _SEPARATOR.join(f"${{{n}}}" for n in names)), _SEPARATOR)
    return bound(parts, lambda p: F.struct(*[F.get(p, F.lit(k)).alias(n) for k, n in enumerate(names)]))


# The character references of markup and of quotes and blanks in text.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#x27;": "'", "&#39;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}


def plain_text(html: Column | str) -> Column:
    """Text of a piece of markup: tags dropped, character references resolved, trimmed."""
    h = F.col(html) if isinstance(html, str) else html
    t = F.when(F.contains(h, F.lit("<")), F.regexp_replace(h, "<[^>]*>", "")).otherwise(h)
    for name, char in ENTITIES.items():
        t = F.replace(t, F.lit(name), F.lit(char))
    return F.regexp_replace(t, r"^[\s\xa0]+|[\s\xa0]+$", "")


def element_text(html: Column | str, css_class: str) -> Column:
    """Text of the first element of a class; NULL where there is none."""
    return plain_text(capture(html, rf"""(?s)<(\w+)\b[^>]*\bclass=["'][^"']*\b{css_class}\b[^"']*["'][^>]*>(.*?)</\1>""", 2))
