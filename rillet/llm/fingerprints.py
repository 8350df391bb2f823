"""Document fingerprints by one-permutation MinHash with optimal densification and b-bit packing.

Every 5-word shingle is hashed once; the hash picks one of 256 bins and a value, and
each bin keeps its smallest value. An empty bin borrows the value of a donor bin that
depends on the bin only, and not on the document: the first filled bin of a fixed
pseudo-random probe sequence. Of each bin the low 4 bits are stored, 16 bins to a long.
Chance agreement of 4-bit values is taken out of the estimate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import let, partitions, sliding, words

BINS = 256  # 8 bits of the hash
BITS = 4
WIDTH = 5
_VALUE = 55  # bits of a bin's value below the 8 bits of the bin
_MASK = (1 << _VALUE) - 1
#: Probes before the fallback; together they are one fixed random order of donors per bin.
PROBES = 6


def _shingle_hashes(text: Column) -> Column:
    """Hashes of all 5-word shingles (fewer words: the whole sequence as one; none: empty), bin in the top bits."""
    def placed(h):
        return F.shiftleft(h.bitwiseAND(F.lit(BINS - 1)), _VALUE).bitwiseOR(F.shiftrightunsigned(h, 64 - _VALUE))

    def of(w):
        many = F.transform(F.sequence(F.lit(0), F.size(w) - WIDTH), lambda i: placed(F.xxhash64(*sliding(w, WIDTH, i))))
        return (F.when(F.size(w) >= WIDTH, many).when(F.size(w) > 0, F.array(placed(F.xxhash64(w))))
                .otherwise(F.array().cast("array<bigint>")))
    return let(words(text), of)


def _bin_minima(hashes: Column) -> Column:
    """The smallest hash of each bin in bin order. One end marker per bin is sorted in, so empty bins hold their marker."""
    ends = F.array(*[F.lit((i << _VALUE) | _MASK) for i in range(BINS)])

    def firsts(s):
        return F.filter(s, lambda v, i: (i == 0) | (F.shiftright(v, _VALUE) != F.shiftright(F.get(s, i - 1), _VALUE)))
    return let(F.sort_array(F.concat(hashes, ends)), firsts)


def _filled(v: Column) -> Column:
    return v.bitwiseAND(F.lit(_MASK)) != F.lit(_MASK)


def _densified(minima: Column) -> Column:
    """Every empty bin takes its first filled donor; a document without shingles gives zeros."""
    def dense(a):
        def donor(v, i):
            probes = [let(F.get(a, F.pmod(F.xxhash64(i, F.lit(t)), F.lit(BINS)).cast("int")), lambda c: F.when(_filled(c), c))
                      for t in range(PROBES)]
            # Few bins are filled: the filled bin that comes first in the bin's own random order.
            last = F.array_min(F.transform(F.filter(a, _filled), lambda u: F.struct(
                F.xxhash64(i, F.shiftright(u, _VALUE)).alias("order"), u.alias("value"))))["value"]
            return F.when(_filled(v), v).otherwise(F.coalesce(*probes, last, F.lit(0)))
        return F.transform(a, donor)
    return let(minima, dense)


def packed_fingerprint(text: Column) -> Column:
    """16 longs of 16 packed 4-bit values."""
    per = 64 // BITS

    def pack(d):
        return F.transform(F.sequence(F.lit(0), F.lit(BINS // per - 1)), lambda k: F.aggregate(
            F.slice(d, k * per + 1, F.lit(per)), F.lit(0).cast("long"),
            lambda acc, v: F.shiftleft(acc, BITS).bitwiseOR(v.bitwiseAND(F.lit((1 << BITS) - 1)))))
    return let(_densified(_bin_minima(_shingle_hashes(text))), pack)


def fingerprint_hex(packed: Column) -> Column:
    return F.lower(F.array_join(F.transform(packed, lambda p: F.lpad(F.hex(p), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance, 0 to 1: share of agreeing bins, less the 1/16 that agree by chance."""
    def differing(x, y):
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        z = z.bitwiseOR(F.shiftrightunsigned(z, 2))
        return F.bit_count(z.bitwiseAND(F.lit(0x1111111111111111)))
    off = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, v: s + v)
    chance = 1.0 / (1 << BITS)
    return F.greatest(F.lit(0.0), ((F.lit(BINS) - off) / F.lit(float(BINS)) - F.lit(chance)) / F.lit(1 - chance))


def _bounds(ids: DataFrame, pieces: int) -> list[int]:
    """Ascending ids that open the pieces: the smallest one, and about evenly spaced quantiles. One row to the driver."""
    shares = [k / pieces for k in range(1, pieces)] or [0.5]
    row = ids.agg(F.min("_key").alias("lo"), F.percentile_approx("_key", shares, max(10_000, 10 * pieces)).alias("q")).first()
    return [] if row["lo"] is None else sorted({row["lo"], *row["q"]})


def _piece(key: Column, bounds: list[int]) -> Column:
    """How many bounds are <= key, by binary search in a literal array."""
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda at, s: F.when(F.get(table, at + s - 1) <= key, at + s).otherwise(at))


def with_next(docs: DataFrame, columns: list[str], id_col: str = "doc_id", tie_col: str = "text") -> DataFrame:
    """Add ``next_<column>`` of the row with the next id (after the last: of the first).

    Null ids come first; rows with equal ids follow each other by text. Rows are dealt
    into id ranges; the first rows of a range are also dealt, as markers, to the range
    before, so each range finds all its successors without meeting another one.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    bounds = _bounds(docs.select(key.alias("_key")), 4 * partitions(spark))
    if not bounds:
        bounds = [0]
    n = len(bounds)
    at = docs.withColumn("_key", key).withColumn("_piece", _piece(F.col("_key"), bounds))
    opens = F.get(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("_piece") - 1) == F.col("_key")
    own = F.struct(F.col("_piece").alias("_to"), F.lit(0).alias("_marker"))
    copy = F.struct(F.when(F.col("_piece") == 1, n).otherwise(F.col("_piece") - 1).alias("_to"), F.lit(1).alias("_marker"))
    # Plain columns and one select: both windows then share one exchange and one sort.
    at = at.select("*", F.inline(F.when(opens, F.array(own, copy)).otherwise(F.array(own))))
    order = Window.partitionBy("_to").orderBy("_marker", "_key", tie_col)
    at = at.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return at.filter("_marker = 0").drop("_key", "_piece", "_to", "_marker")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    A null text counts as empty; texts without words share one fingerprint of zeros and
    are alike (1.0); equal texts have equal fingerprints. A single row is its own next.
    Very long texts stay whole: their hashes are one array of longs in one row.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("_fp", packed_fingerprint(F.col("text")))
    rows = with_next(rows, ["text", "_fp"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("_edited", F.concat(F.col("text").substr(F.lit(1), n - half), F.col("next_text").substr(F.lit(1), half)))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("_edited"), 256).alias("edited_sha256"),
                       "_fp", F.col("next__fp"), packed_fingerprint(F.col("_edited")).alias("_efp"))
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprint_hex(F.col("_fp")).alias("fingerprint"),
                       fingerprint_hex(F.col("_efp")).alias("edited_fingerprint"),
                       likeness(F.col("_fp"), F.col("_efp")).alias("near_edited"),
                       likeness(F.col("_fp"), F.col("next__fp")).alias("near_next"))
