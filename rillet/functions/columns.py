"""Pure Column builders (projections and scalar functions).

Each function takes and returns ``Column`` objects made only of built-in
Spark expressions, so they stay inside whole-stage codegen and work the same
on batch and streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- numbers

def round_half_even(c: ColumnOrName, places: int = 2) -> Column:
    """numpy-style ``round(places)``: scale, round half to even, unscale.

    Spark's ``round`` rounds half up on the decimal value and ``bround`` on
    the decimal text; numpy works on the scaled double, which ``rint`` matches.
    """
    scale = float(10 ** places)
    return F.rint(_c(c) * F.lit(scale)) / F.lit(scale)


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN becomes NULL so that comparisons fall through like in pandas."""
    return F.nanvl(_c(c), F.lit(None).cast("double"))


def clamp(c: ColumnOrName, lo: float | None = 0.0, hi: float | None = 100.0) -> Column:
    """``max(lo, min(hi, x))``; either bound may be left out."""
    out = _c(c)
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if lo is not None:
        out = F.greatest(F.lit(lo), out)
    return out


def float_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division with IEEE float rules, as pandas/numpy compute it: x/0 is
    +/-inf, 0/0 is NaN, NULL stays NULL (ANSI mode would raise instead)."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    inf = F.lit(float("inf"))
    return (F.when(n.isNull() | d.isNull(), F.lit(None).cast("double")).when(d != 0, n / d)
            .when(n > 0, inf).when(n < 0, -inf).otherwise(F.lit(float("nan"))))


def pct_change(new: ColumnOrName, base: ColumnOrName) -> Column:
    """``(new - base) / base * 100`` with float rules (base 0 -> +/-inf or NaN)."""
    return float_div(_c(new) - _c(base), _c(base)) * F.lit(100.0)


def deviation_pct(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Relative deviation ``(a-b)/b*100``, 0 when b <= 0 (or b is NULL/NaN)."""
    b = _c(b)
    return F.when(b > 0, (_c(a) - b) / b * F.lit(100.0)).otherwise(F.lit(0.0))


def coef_variation(std: ColumnOrName, mean: ColumnOrName) -> Column:
    """``std/mean*100``, 0 when mean <= 0; a NULL std stays NULL."""
    mean = _c(mean)
    return F.when(mean > 0, _c(std) / mean * F.lit(100.0)).otherwise(F.lit(0.0))


def masked_ratio(num: ColumnOrName, den: ColumnOrName, mask: Column) -> Column:
    """``num/den`` only where ``mask`` holds, NULL elsewhere."""
    return F.when(mask, F.try_divide(_c(num), _c(den)))


def range_position(x: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName,
                   default: float = 50.0) -> Column:
    """Percent position of ``x`` in ``[lo, hi]`` with float division rules.

    ``hi == lo`` gives +/-inf for ``x != lo`` and NaN (then ``default``) for
    ``x == lo``; missing bounds give ``default``.
    """
    x, lo, hi = _c(x), _c(lo), _c(hi)
    inf = F.lit(float("inf"))
    flat = F.when(x > lo, inf).when(x < lo, -inf)
    pos = F.when(hi == lo, flat).otherwise((x - lo) / (hi - lo) * F.lit(100.0))
    return F.coalesce(pos, F.lit(default))


def row_sum(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise sum with NULL counted as 0."""
    out = F.lit(0.0)
    for c in cols:
        out = out + F.coalesce(_c(c).cast("double"), F.lit(0.0))
    return out


def row_argmax(cols: Sequence[str], names: Sequence[str] | None = None) -> Column:
    """Name of the largest column per row (NULL as 0; the first wins a tie)."""
    names = list(names or cols)
    vals = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    labels = F.array(*[F.lit(n) for n in names])
    return F.element_at(labels, F.array_position(vals, F.array_max(vals)).cast("int"))


def decade(year: ColumnOrName) -> Column:
    """``year // 10 * 10`` as a nullable int."""
    return (F.floor(_c(year) / F.lit(10)) * F.lit(10)).cast("int")


def comfort_index(temp: ColumnOrName, humidity: ColumnOrName) -> Column:
    """``100 - |t - 22| * 2 - rh * 0.3``."""
    return F.lit(100.0) - F.abs(_c(temp) - F.lit(22.0)) * F.lit(2.0) - _c(humidity) * F.lit(0.3)


# ---------------------------------------------------------------- text

def parse_money(c: ColumnOrName, symbol: str = "US$") -> Column:
    """``'US$1,234'`` -> 1234.0; anything unparsable -> NULL."""
    txt = F.replace(F.replace(_c(c).cast("string"), F.lit(symbol), F.lit("")), F.lit(","), F.lit(""))
    return F.trim(txt).try_cast("double")


def first_int(c: ColumnOrName) -> Column:
    """First run of digits as a double, NULL when there is none."""
    digits = F.regexp_extract(_c(c).cast("string"), r"(\d+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("double")


# Letters and non-letters alternate; each letter run is capitalised on its own,
# which is what Python's str.title() does (``mr-mime`` -> ``Mr-Mime``).
_TITLE_RUNS = r"(\p{L}+|[^\p{L}]+)"


def title_case(c: ColumnOrName) -> Column:
    """Python ``str.title()``: capitalise every run of letters."""
    runs = F.regexp_extract_all(_c(c), F.lit(_TITLE_RUNS), 1)
    return F.array_join(F.transform(runs, lambda x: F.initcap(x)), "")


def absolute_url(c: ColumnOrName, prefix: str = "item?id=",
                 base: str = "https://news.ycombinator.com/") -> Column:
    """Turn a relative ``item?id=`` link into an absolute one."""
    c = _c(c)
    return F.when(c.startswith(prefix), F.concat(F.lit(base), c)).otherwise(c)


def url_authority(c: ColumnOrName, default: str = "news.ycombinator.com") -> Column:
    """``netloc`` of an absolute link (port and user info kept), else ``default``.

    A malformed absolute URL gives NULL rather than an error.
    """
    c = _c(c)
    return F.when(c.startswith("http"), F.try_parse_url(c, F.lit("AUTHORITY"))).otherwise(F.lit(default))


def regex_flag(c: ColumnOrName, pattern: str, negate: bool = False) -> Column:
    """Regex 'contains' test as a never-NULL boolean."""
    hit = F.coalesce(_c(c).rlike(pattern), F.lit(False))
    return ~hit if negate else hit


def leading_count(text: ColumnOrName, keyword: str = "comment") -> Column:
    """Count from text like ``'12 comments'``: digits at the start, only if the
    text contains ``keyword``; 0 otherwise."""
    t = F.trim(_c(text))
    n = F.nullif(F.regexp_extract(t, r"^(\d+)(\s|\xa0|$)", 1), F.lit("")).try_cast("int")
    return F.when(t.contains(keyword), F.coalesce(n, F.lit(0))).otherwise(F.lit(0))


def snake_case_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name and replace spaces by ``_``."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def strip_suffix(names: Iterable[str], suffix: str) -> list[str]:
    """Driver-side name clean-up (``na_sales`` -> ``na``)."""
    return [n[: -len(suffix)] if n.endswith(suffix) else n for n in names]


# ---------------------------------------------------------------- network

# Protocol families, as the reference names them.
PROTOCOL_FAMILIES = [
    ("tcp", ["TCP", "6"]),
    ("udp", ["UDP", "17"]),
    ("icmp", ["ICMP", "1"]),
    ("http", ["HTTP", "HTTPS"]),
]


def protocol_family(c: ColumnOrName) -> Column:
    """Protocol name or number -> ``tcp``/``udp``/``icmp``/``http``/``other``."""
    up = F.upper(_c(c).cast("string"))
    out = None
    for fam, codes in PROTOCOL_FAMILIES:
        out = (F.when if out is None else out.when)(up.isin(codes), F.lit(fam))
    return out.otherwise(F.lit("other"))


def is_private_ipv4(c: ColumnOrName) -> Column:
    """10/8, 172.16/12 or 192.168/16; malformed text -> False."""
    parts = F.split(_c(c).cast("string"), r"\.")
    first = F.get(parts, 0).try_cast("int")
    second = F.get(parts, 1).try_cast("int")
    ok = (F.size(parts) == 4) & first.isNotNull() & second.isNotNull()
    private = (first == 10) | ((first == 172) & second.between(16, 31)) | ((first == 192) & (second == 168))
    return F.coalesce(ok & private, F.lit(False))


# ---------------------------------------------------------------- dates

def parse_timestamp(c: ColumnOrName, fmt: str) -> Column:
    """Coercing parse with an explicit format; bad text -> NULL."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("timestamp_ntz")


def parse_utc(c: ColumnOrName) -> Column:
    """Coercing parse of an ISO date or time text, with or without fraction and zone; a text
    without a zone, and the result, are in the session's zone (UTC). Bad text -> NULL."""
    return F.try_to_timestamp(_c(c)).cast("timestamp_ntz")


def date_parts(ts: ColumnOrName) -> dict[str, Column]:
    """Year, month and English day name of a timestamp."""
    ts = _c(ts)
    return {"year": F.year(ts), "month": F.month(ts), "day_of_week": F.date_format(ts, "EEEE")}


def whole_days_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Floor of elapsed 24 h units, negative when ``earlier`` is after ``later``."""
    micros = F.timestamp_diff("MICROSECOND", _c(earlier), _c(later))
    return F.floor(micros / F.lit(86_400_000_000)).cast("long")


def epoch_seconds_to_ts(c: ColumnOrName) -> Column:
    return F.timestamp_seconds(_c(c))


def epoch_millis_to_ts(c: ColumnOrName) -> Column:
    return F.timestamp_millis(_c(c).cast("long"))


# ---------------------------------------------------------------- frames

def with_coerced_numbers(df: DataFrame, cols: Iterable[str], to: str = "double") -> DataFrame:
    """``pd.to_numeric(errors='coerce')`` on a set of columns."""
    return df.withColumns({c: F.col(c).cast("string").try_cast(to) for c in cols if c in df.columns})


def with_rounded(df: DataFrame, cols: Iterable[str], places: int = 2) -> DataFrame:
    """Round a list of columns numpy-style; absent columns are skipped."""
    return df.withColumns({c: round_half_even(c, places) for c in cols if c in df.columns})


def when_columns_exist(df: DataFrame, needed: Iterable[str], derive) -> DataFrame:
    """Schema guard: apply ``derive(df)`` only if every needed column exists."""
    return derive(df) if all(c in df.columns for c in needed) else df


def renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names not present are ignored, like pandas."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
