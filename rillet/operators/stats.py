"""Global statistics attached to rows, and exact quantiles from sketches and counts.

A global statistic is a one-row aggregate (partial aggregation on every
partition, one tiny final merge) that is a scalar subquery of the rows' plan.
No unpartitioned window and no cross join is used.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_global_stats(df: DataFrame, stats: Mapping[str, Column] | DataFrame) -> DataFrame:
    """Attach one-row statistics (an aggregate spec or a one-row frame) to every row.

    They are one uncorrelated scalar subquery of the rows' own plan: building the frame runs
    no job, the statistics are computed once before the rows, and tasks get their values as
    constants, without a join. They are NULL where the one-row frame is empty.
    """
    one = stats if isinstance(stats, DataFrame) else df.agg(*[c.alias(k) for k, c in stats.items()])
    row = one.select(F.struct(*[F.col(f"`{c}`") for c in one.columns]).alias("_stats")).scalar()
    return df.withColumn("_stats", row).withColumns({c: F.col("_stats")[c] for c in one.columns}).drop("_stats")


def _qname(q: float) -> str:
    return "q" + (f"{q:.6f}".rstrip("0").rstrip(".").replace("0.", "", 1) or "0")


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """One-row frame with the exact, linearly interpolated quantiles of ``col``.
    NULL (and NaN, which pandas skips) are ignored; see ``exact_quantiles_many``."""
    names = list(names or [_qname(q) for q in qs])
    return exact_quantiles_many(df, [(col, q, n) for q, n in zip(qs, names)])


#: Accuracy of the sketch: a rank it reports is off by at most 1 / ACCURACY of all rows.
ACCURACY = 10_000
#: Values that a bracket may send to the driver, each with its count; a larger one is cut into as many bins first.
BRACKET = 1 << 15


def _number(c: str) -> Column:
    v = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(v), v)


def _bin(v: Column, lo: float, hi: float, bins: int) -> Column:
    """Bin of equal width of a value from ``lo`` to ``hi``; infinite ends have a bin of their own."""
    # Halves first: the width of a range may exceed the largest double.
    share = F.coalesce(F.try_divide(v / 2 - lo / 2, F.lit(hi / 2 - lo / 2)), F.when(v > lo, 1.0).otherwise(0.0))
    if lo == float("-inf") or hi == float("inf"):
        share = F.when(v == float("-inf"), 0.0).when(v == float("inf"), 1.0).otherwise(0.5)
    return F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")


def _order_statistics(df: DataFrame, brackets: Mapping[tuple[str, int], tuple[float, float, int]]) -> dict[tuple[str, int], float]:
    """Values at the wanted 0-based ranks (column, rank), each known to lie in a bracket (lo, hi, rows at most in it).

    A pass counts the values under every bracket and, inside it, the rows of each value
    (combined on the map side, so a shuffle carries counts only). A bracket of more rows
    than ``BRACKET`` is counted by bins of equal width instead, and the bin that holds the
    rank is the next bracket. A rank that lies outside its bracket after all is looked for
    on that side of it.
    """
    found: dict[tuple[str, int], float] = {}
    todo = dict(brackets)
    while todo:
        spans = sorted({(c, lo, hi, most > BRACKET) for (c, _), (lo, hi, most) in todo.items()})
        entries = []
        for i, (c, lo, hi, wide) in enumerate(spans):
            v = _number(c)
            key = F.struct(F.lit(i).alias("s"), (_bin(v, lo, hi, BRACKET) if wide and lo < hi else F.lit(0)).alias("b"),
                           (F.lit(0.0) if wide else v).alias("k"), v.alias("v"))
            below = F.struct(F.lit(i).alias("s"), F.lit(-1).alias("b"), F.lit(0.0).alias("k"), v.alias("v"))
            entries.append(F.when(v.between(lo, hi), key).when(v < lo, below))
        rows = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
        counts = rows.groupBy("s", "b", "k").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        by_span: dict[int, list] = {}
        for r in sorted(counts, key=lambda r: (r["s"], r["lo"])):
            by_span.setdefault(r["s"], []).append(r)
        for (c, rank), (lo, hi, most) in list(todo.items()):
            groups, left = by_span.get(spans.index((c, lo, hi, most > BRACKET)), []), rank
            for g in groups:
                if left < g["n"]:
                    break
                left -= g["n"]
            else:
                g = None  # above the bracket
            if g is not None and g["lo"] == g["hi"]:
                found[c, rank] = g["lo"]
                del todo[c, rank]
            else:
                todo[c, rank] = (math.nextafter(hi, math.inf), math.inf, 1 << 62) if g is None else (g["lo"], g["hi"], g["n"])
    return found


def exact_quantiles_many(df: DataFrame, specs: Sequence[tuple[str, float, str]]) -> DataFrame:
    """Exact quantiles of several columns: ``specs`` is ``(column, q, output name)``; the
    result is one row, NULL for a column without values. Interpolation is numpy's (what
    pandas uses).

    Two passes over the rows: mergeable quantile sketches, one a column, count the values
    and bracket every wanted rank; then the few values inside the brackets are counted
    exactly. No sort, no stacked copy, nothing cached; only sketches and counts move. (Over
    ``BRACKET * ACCURACY / 4`` rows, some 10^8, a bracket is narrowed by a pass of bins first.)
    """
    cols = list(dict.fromkeys(c for c, _, _ in specs))
    slack = 2 / ACCURACY
    wanted = {c: sorted({x for d, q, _ in specs if d == c for x in (max(0.0, q - slack), min(1.0, q + slack))}) for c in cols}
    stats = df.agg(*[x for i, c in enumerate(cols) for x in (
        F.count(_number(c)).alias(f"n{i}"), F.min(_number(c)).alias(f"lo{i}"), F.max(_number(c)).alias(f"hi{i}"),
        F.percentile_approx(_number(c), wanted[c], ACCURACY).alias(f"p{i}"))]).first()
    total = {c: stats[f"n{i}"] for i, c in enumerate(cols)}
    places = [(c, q, (total[c] - 1) * q) for c, q, _ in specs]
    brackets = {}
    for c, q, h in places:
        if total[c]:
            i = cols.index(c)
            lows, highs = (wanted[c].index(x) for x in (max(0.0, q - slack), min(1.0, q + slack)))
            lo = stats[f"p{i}"][lows] if q > slack else stats[f"lo{i}"]
            hi = stats[f"p{i}"][highs] if q < 1 - slack else stats[f"hi{i}"]
            for r in {math.floor(h), math.ceil(h)}:
                brackets[c, r] = (lo, hi, math.ceil(2 * slack * total[c]))
    at = _order_statistics(df, brackets)
    values = []
    for c, _, h in places:
        if not total[c]:
            values.append(None)
            continue
        lo, hi, t = at[c, math.floor(h)], at[c, math.ceil(h)], h - math.floor(h)
        # From the nearer end, so results are exact at the bracketing values.
        values.append(hi - (hi - lo) * (1.0 - t) if t >= 0.5 else lo + (hi - lo) * t)
    return df.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(n) for v, (_, _, n) in zip(values, specs, strict=True)])


def quantile_flags(df: DataFrame, specs: Sequence[tuple[str, str, float, str]]) -> DataFrame:
    """Strict threshold flags against global quantiles.

    ``specs``: ``(out_name, column, q, op)`` with op ``'>'`` or ``'<'``. All thresholds
    come from one set of counting passes and are inlined as literals; flags are never NULL.
    """
    wanted = list(dict.fromkeys((c, q) for _, c, q, _ in specs))
    row = exact_quantiles_many(df, [(c, q, f"_q_{i}") for i, (c, q) in enumerate(wanted)]).first()
    thresholds = {cq: F.lit(row[i]).cast("double") for i, cq in enumerate(wanted)}
    return df.withColumns({name: F.coalesce(F.col(c) > thresholds[c, q] if op == ">" else F.col(c) < thresholds[c, q], F.lit(False))
                           for name, c, q, op in specs})


def max_normalize(df: DataFrame, col: str, out: str, places: int = 2) -> DataFrame:
    """``x / max(x) * 100`` rounded numpy-style; 0 when the maximum is <= 0."""
    from rillet.functions.columns import round_half_even

    with_max = with_global_stats(df, {"_max": F.max(col)})
    val = F.when(F.col("_max") > 0, round_half_even(F.col(col) / F.col("_max") * F.lit(100.0), places))
    return with_max.withColumn(out, F.coalesce(val, F.lit(0.0))).drop("_max")
