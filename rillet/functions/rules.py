"""Rule-based classification and scoring as ordered CASE expressions.

* ``classify``: first matching rule wins; a NULL test counts as false, so a
  NULL input reaches the default (pandas' ``NaN > x`` is False too).
* ``bucketize``: left-open, right-closed bins like ``pd.cut``; outside -> NULL.
* ``score``: a base plus additive penalties/bonuses, optionally clamped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillet.functions.columns import ColumnOrName, _c, clamp


def flag(cond: Column) -> Column:
    """Boolean that is never NULL (a NULL test is False)."""
    return F.coalesce(cond, F.lit(False))


def classify(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Ordered ``CASE WHEN``; ``default=None`` leaves unmatched rows NULL."""
    out = None
    for cond, label in rules:
        val = label if isinstance(label, Column) else F.lit(label)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def bucketize(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``pd.cut(x, edges, labels)``: bin i is ``(edges[i], edges[i+1]]``.

    Values on or below the lowest edge, above the top edge, NULL or NaN get
    NULL. Use ``float('inf')`` as the top edge for an open last bin.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need len(edges) == len(labels) + 1")
    x = _c(c)
    rules = []
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = x > F.lit(float(lo))
        if hi != float("inf"):
            cond = cond & (x <= F.lit(float(hi)))
        rules.append((cond & ~F.isnan(x), lab))
    return classify(rules)


def score(terms: Sequence[tuple[Column, float]], base: float = 0.0,
          lo: float | None = None, hi: float | None = None) -> Column:
    """``base + sum(points for each true condition)``, clamped to [lo, hi]."""
    out = F.lit(float(base))
    for cond, pts in terms:
        out = out + F.when(flag(cond), F.lit(float(pts))).otherwise(F.lit(0.0))
    if lo is not None or hi is not None:
        out = clamp(out, lo, hi)
    return out


def onehot_decode(cols: Sequence[str], names: Sequence[str] | None = None,
                  default: str = "unknown") -> Column:
    """Category from one-hot columns: the last column equal to 1 wins."""
    names = list(names or cols)
    picks = [F.when(F.col(c).cast("int") == 1, F.lit(n)) for c, n in zip(cols, names)]
    return F.coalesce(*reversed(picks), F.lit(default))


def tri_state(c: ColumnOrName, true_label: str = "Success", false_label: str = "Failure",
              null_label: str = "Unknown") -> Column:
    """Nullable boolean -> three labels."""
    c = _c(c)
    return F.when(c, F.lit(true_label)).when(~c, F.lit(false_label)).otherwise(F.lit(null_label))
