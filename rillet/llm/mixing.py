"""Mixing sources to target weights, by Pareto order sampling.

Every source gets a target in words. Its ratio to the source's size is the number of
copies expected of each of its documents: the whole part is allocated to all of them, the
rest is an inclusion probability p that differs from source to source. Documents are ranked
by u / (1 - u) over p / (1 - p) with a stable random number u of the id (Pareto order), and
the first ones of a source get one more copy, as many as the words that are left allow. The
size of a sample is fixed in words, not expected: the order is cut where the next document
would exceed what is left. A second cut of the later documents of at most an eighth of the
gap narrows it, and the last copy goes to the document whose size comes nearest to what
then is open, if that is nearer than none.

A source may hold any share of the rows. Its order is cut into ranges of the rank; sums of
the ranges, which are combined before the shuffle, show the one range that the cut lies in,
and only the rows of that range are ordered one by one. Sources are numbered and filled up
without the driver or one task seeing all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import landed, words

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix in percent of all words, and the most copies of a document.
PERCENT, MOST_COPIES = 150, 2
#: Ranges of ranks in each source.
RANGES = 4096
#: Cuts of the order; each after the first takes documents of at most 1 / FINER of the gap.
CUTS, FINER = 2, 8


def uniform(key: Column) -> Column:
    """A stable number between 0 and 1 (both excluded) of a value's text: 52 bits of its MD5."""
    digits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10)
    return (digits.cast("double") + 0.5) / F.lit(float(1 << 52))


def _weighted(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Sources (source, s_size) with weight ``w``, repeating in code-point order with null last.

    The sorted sources are written once; a source's number is its place in its partition
    after the sources of the partitions before, of which there is one row each.
    """
    at = F.monotonically_increasing_id()
    known = landed(sources.orderBy(F.asc_nulls_last("source")).select("source", "s_size", F.shiftright(at, 33).alias("part"),
                                                                      at.bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = known.groupBy("part").agg(F.count("*").alias("c")).select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("shift"))
    k = F.pmod(F.col("shift") + F.col("at"), F.lit(len(weights))).cast("int")
    return known.join(shift, "part").select("source", "s_size", F.get(F.array(*(F.lit(float(w)) for w in weights)), k).alias("w"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, percent: int = PERCENT, most: int = MOST_COPIES) -> DataFrame:
    """source, s_size and target of the sources of (source, size).

    Together the targets are ``percent`` of all sizes (at most ``most`` times those), shared
    by weight. A target stops at ``most`` times its source's size; what exceeds it is shared
    among the others by weight, until none is above. Every round looks at all sources and
    stops at least one more; only its three sums reach the driver.
    """
    known = landed(_weighted(sizes.groupBy("source").agg(F.sum("size").alias("s_size")), weights), "weights")
    cap = F.lit(float(most)) * F.col("s_size")
    total = known.agg(F.sum("s_size")).first()[0] or 0
    budget, stopped, level = percent / 100 * total, -1, 0.0
    if budget >= most * total:  # every source is taken whole
        return known.select("source", "s_size", cap.alias("target"))
    while True:
        over = cap < F.lit(level) * F.col("w")
        count, held, open_w = known.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)), F.sum(F.when(~over, F.col("w")))).first()
        if count == stopped:
            break
        stopped, level = count, (budget - held) / open_w
    return known.select("source", "s_size", F.least(cap, F.lit(level) * F.col("w")).alias("target"))


def _with_rest(known: DataFrame) -> DataFrame:
    """Targets with the whole copies of every document, the words left for the sample, and its share ``p`` of the source."""
    whole = F.when(F.col("s_size") > 0, F.floor(F.col("target") / F.col("s_size"))).otherwise(0).cast("long")
    rest = F.col("target") - F.col("whole") * F.col("s_size")
    return known.withColumns({"whole": whole, "rest": rest}).withColumn("p", F.when(F.col("s_size") > 0, F.col("rest") / F.col("s_size")).otherwise(0.0))


def _per_source(rows: DataFrame, sources: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with the columns of their source's row; null is a source. There is one row a source,
    so AQE broadcasts few sources and splits the hot ones of many."""
    return rows.join(sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), how).drop("_s")


def _cuts(ranked: DataFrame) -> DataFrame:
    """source, edge and gap: the order key of the last row of the source's sample (null if none) and the words still open."""
    sums = ranked.groupBy("source", "range").agg(F.sum("size").alias("in_range"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("source").orderBy("range")
    sums = sums.withColumn("upto", F.sum("in_range").over(upto)).withColumn("before", F.col("upto") - F.col("in_range"))
    # The first range that the cut can lie in; a source whose sample takes all its rows has none.
    ranges = landed(sums.groupBy("source").agg(
        F.min(F.when(F.col("upto") > F.col("rest"), F.struct("range", "before"))).alias("cut"), F.first("rest").alias("rest"),
        F.max("upto").alias("all"), F.max("range").alias("top"))
        .select("source", "rest", F.coalesce("cut.range", F.col("top") + 1).alias("cut_range"), F.coalesce("cut.before", "all").alias("before")), "ranges")
    inside = _per_source(ranked.drop("rest"), ranges).filter("range = cut_range")
    running = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    edges = (inside.withColumn("upto", F.col("before") + F.sum("size").over(running)).filter("upto <= rest")
             .groupBy("source").agg(F.max("key").alias("edge"), F.max("upto").alias("upto")))
    return _per_source(ranges, edges, "left").select("source", "cut_range", "edge", (F.col("rest") - F.coalesce("upto", "before")).alias("gap"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, percent: int = PERCENT, most: int = MOST_COPIES,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every row.

    ``size`` counts the words of the text (parted by 09 to 0D, 20; null: 0), ``target`` is
    in words and the same for a source's rows, ``copies`` is 0 to ``most`` and ``taken`` is
    copies * size. Rows without words get no copy by rank. Reruns give the same rows: u
    depends on the id alone, ties go by the id's text, then size; rows equal in these are
    interchangeable. Null sources are one source, null ids rank as an empty id. No rows give
    no rows.
    """
    rows = landed(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                              F.size(words(F.col(f"`{text_col}`").cast("string"))).cast("long").alias("size"),
                              F.monotonically_increasing_id().alias("row")), "sizes")
    known = landed(_with_rest(targets(rows, weights, percent, most)), "targets")
    u = uniform(F.col("doc_id"))
    odds = F.when((F.col("size") > 0) & (F.col("p") > 0), u / (1 - u) / (F.col("p") / (1 - F.col("p"))))
    ranked = _per_source(rows, known).withColumn("rank", odds)
    ranked = landed(ranked.withColumns({
        "range": F.floor(F.col("rank") / (1 + F.col("rank")) * RANGES).cast("int"),
        "key": F.when(F.col("rank").isNotNull(), F.struct("rank", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "size", "row"))}), "ranked")
    state = ranked.withColumn("taken", F.lit(False))
    for k in range(CUTS):
        fits = ~F.col("taken") & F.col("key").isNotNull() & (F.lit(k == 0) | (F.col("size") * FINER <= F.col("rest")))
        cuts = landed(_cuts(state.filter(fits).select("source", "size", "range", "key", "rest")), "cuts")
        chosen = fits & F.coalesce((F.col("range") < F.col("cut_range")) | (F.col("key") <= F.col("edge")), F.lit(False))
        state = landed(_per_source(state, cuts, "left").withColumn("taken", F.col("taken") | chosen)
                       .withColumn("rest", F.coalesce("gap", "rest")).drop("cut_range", "edge", "gap"), "taken")
    off = F.abs(F.col("rest") - F.col("size"))
    last = (state.filter(~F.col("taken") & F.col("key").isNotNull() & (off < F.col("rest")))
            .groupBy("source").agg(F.min(F.struct(off.alias("off"), F.col("key"))).alias("m")).select("source", F.col("m.key.row").alias("last")))
    out = _per_source(state, landed(last, "last"), "left")
    copies = F.col("whole") + F.when(F.col("taken") | F.coalesce(F.col("row") == F.col("last"), F.lit(False)), 1).otherwise(0)
    return out.select("doc_id", "source", "size", F.col("s_size").alias("source_size"), "target", copies.cast("int").alias("copies"),
                      (copies * F.col("size")).cast("long").alias("taken"))
