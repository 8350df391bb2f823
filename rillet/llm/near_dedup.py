"""Near-duplicate classes by SetSketch registers, banded joins, likelihood estimates and exact verification.

A document's set holds the hashes of its distinct word shingles. A register is the
truncated logarithm (base 1.2) of the smallest of the set's exponential hash values, so
registers merge by maximum, fit in a byte, and two registers agree with a probability
that follows the resemblance of the sets. Of 1024 registers 130 make 26 bands of 5: a
pair with resemblance 0.8 meets in no band with probability 0.00001. All 1024 estimate
the resemblance of pairs that meet, to a standard error of 0.013; pairs five such errors
under the asked resemblance are not verified.

Equal sets are one set from the start. In a bucket (equal band values) every set is to be
compared with the bucket's first one, but not with all its firsts at once: in a round each
set meets the smallest of them, linked sets form components, and the next round compares
only what then lies in different components. So a large group of near copies costs
about a row a set, however many buckets its sets share. In buckets that
still hold several components, the sets outside the first one's component are compared
with all others, in blocks of bounded size inside the tasks: by their registers, and likely
pairs by the sets themselves; only links leave a task, each from its first common band. So no bucket
is expanded into pairs, none is gathered in a task, and every two sets that share a
bucket end in one component or have been compared.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from rillet.llm.common import bit_table, landed, marked, tidied

BANDS, ROWS, REGISTERS = 26, 5, 1024
#: SetSketch parameters: registers are floor(1 - log_BASE(x)) within 0 .. TOP, of x with rate RATE.
BASE, RATE, TOP = 1.2, 20.0, 255
#: Standard errors that an estimate may fall short of the asked resemblance, and the measured
#: standard error over that of as many independent trials (up to 0.0136 against 0.0125 at 0.8).
ERRORS, EXCESS = 5.0, 1.09
#: Sets of one side of a block of comparisons.
BLOCK = 1024
#: Members that the sets of one side of a block have together, about.
BLOCK_MEMBERS = 1 << 19
#: Characters of the texts that are verified together against one text.
TOGETHER = 1 << 22
#: Firsts that a set meets in each round; one more round takes all the pairs that are then left.
PARTNERS = (1, 4)

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``width`` words; fewer words are one shingle, none give none.

    Words are runs of characters other than white space, with A-Z in lower case.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < width:
        out = np.uint64(len(h)) * _M1
        for x in h:
            out = _mix(np.array([out ^ x], np.uint64) * _M1)[0]
        return np.array([out], np.uint64)
    total = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        total = _mix(total * _M1 + h[k:len(h) - width + 1 + k])
    return np.unique(total)


@lru_cache(maxsize=1)
def _multipliers() -> np.ndarray:
    return (_mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * _M1) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The set's registers (a byte each). Registers of a union are the maxima of the registers."""
    a, h = _multipliers()[None, :], (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(h), 128):  # a block of products that stays in the cache
        np.minimum(least, (h[at:at + 128, None] * a).min(0), out=least)
    x = -np.log1p(-np.minimum((least.astype(float) + 1) / 2.0**32, 1 - 2.0**-33)) / RATE
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, TOP).astype(np.uint8)


def band_keys(reg: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each register row, of the band's number and register values."""
    bands = reg.reshape(-1, REGISTERS)[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _M1, bands.shape[:2])
    for k in range(ROWS):
        key = _mix(key * _M1 + bands[:, :, k])
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, grid: int = 101) -> np.ndarray:
    """Maximum-likelihood resemblance of register rows ``a``, ``b`` of sets with ``na``, ``nb`` elements.

    The likelihood joins the counts of larger, smaller and equal registers; resemblance
    is searched on a grid up to its bound min(n) / max(n).
    """
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    u = (na / (na + nb))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, grid)[None, :] * np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / math.log(BASE)
    up, down = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
    same = np.maximum(1 - up - down, 1e-12)
    score = more * np.log(up) + less * np.log(down) + (REGISTERS - more - less) * np.log(same)
    return j[np.arange(len(j)), score.argmax(1)]


def _sketch(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, size, digest, sketch = [], [], [], []
        for t in b.column(1):
            text = t.as_py()
            s = shingle_set(text, width)
            n.append(len(s))
            size.append(len(text or ""))
            digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            r = registers(s) if len(s) else np.zeros(REGISTERS, np.uint8)
            sketch.append(r.tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(sketch, pa.binary())],
                                         ["doc_id", "n", "size", "digest", "sketch"])


def sketches(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (set size), size (characters of the text), digest of the set, sketch (a byte per register)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(_sketch, width=width), "doc_id long, n long, size long, digest binary, sketch binary")


def _rows(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(s.as_py() for s in sketches), np.uint8).reshape(-1, REGISTERS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = band_keys(_rows(b.column(2)))
        ends = pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))], ["id", "n", "keys"])


def _least(percent: int) -> float:
    """Smallest estimate that is verified."""
    p = percent / 100
    return p - ERRORS * EXCESS * math.sqrt(p * (1 - p) / REGISTERS)


def _likely(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = np.zeros(b.num_rows, bool)
        for at in range(0, b.num_rows, 1024):
            part = b.slice(at, 1024)
            sizes = (part.column(k).to_numpy().astype(float) for k in (2, 3))
            keep[at:at + 1024] = estimate(_rows(part.column(4)), _rows(part.column(5)), *sizes) >= _least(percent)
        yield b.select(["a", "b", "size"]).filter(pa.array(keep))


def _block_links(block: pa.Table, percent: int) -> pa.Table:
    """Links between the outsiders and the members of one block: of different components, of sizes
    that allow it, from the first band that both share, likely by their registers and then
    counted on the full sets."""
    block = block.combine_chunks()
    outside = block.column("outside").to_numpy(zero_copy_only=False)
    ids, n, component = (block.column(c).to_numpy() for c in ("id", "n", "component"))
    reg = _rows(block.column("sketch").combine_chunks())
    sets = [np.frombuffer(x.as_py(), np.uint64) for x in block.column("hashes")]
    bands = band_keys(reg)
    band = int(np.flatnonzero(bands[0] == block.column("key")[0].as_py())[0])
    rest = np.flatnonzero(~outside)
    found: list[tuple[int, int]] = []
    for k in np.flatnonzero(outside):
        fits = rest[(component[rest] != component[k]) & (100 * np.minimum(n[rest], n[k]) >= percent * np.maximum(n[rest], n[k]))]
        if band:
            fits = fits[~(bands[fits, :band] == bands[k, :band]).any(1)]
        if len(fits):
            near = estimate(np.broadcast_to(reg[k], (len(fits), REGISTERS)), reg[fits], np.full(len(fits), float(n[k])), n[fits].astype(float))
            found += [(min(ids[k], ids[x]), max(ids[k], ids[x])) for x in fits[near >= _least(percent)] if _linked(sets[k], sets[x], percent)]
    pairs = np.array(sorted(set(found)), np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets of hashes share enough of all their members."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _hashed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingle_set(t.as_py(), width).tobytes() for t in b.column(1)]
        digests = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.binary()), pa.array(sets, pa.binary())], ["id", "digest", "hashes"])


def _alike(group: pa.Table, width: int, percent: int) -> pa.Table:
    """The sets of one group that are linked with its first set: ``own`` marks the rows of that one
    (several where an id has several texts, of which each may link)."""
    rows = list(zip(group.column("own").to_pylist(), group.column("id").to_pylist(), group.column("text"), strict=True))
    firsts = [(i, shingle_set(t.as_py(), width)) for own, i, t in rows if own]
    linked = set()
    for own, i, t in rows:
        if own:
            continue
        other = shingle_set(t.as_py(), width)
        if any(_linked(first, other, percent) for _, first in firsts):
            linked.add(i)
    return pa.table({"a": pa.array([firsts[0][0]] * len(linked), pa.int64()), "b": pa.array(sorted(linked), pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """id and component (smallest id reachable) of every end of the edges (a, b).

    Alternating stars: ids above an id hang themselves on its smallest neighbour, then
    ids below do, until nothing changes. Each step is a minimum per id and a join; the
    edge table of each step is written, so no lineage grows.
    """
    def star(e: DataFrame, larger: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else \
            e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = both.join(least, "a")
        if larger:  # neighbours above the id hang on the smallest neighbour
            moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:  # the id and its smaller neighbours hang on the smallest
            moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        return moved.filter("a != b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    at = landed(edges.filter("a != b").distinct(), "edges")
    before = None
    while (now := state(at)) != before:
        before = now
        at = landed(star(star(at, True), False), "edges")
    # Stars: every id hangs on the smallest one.
    ends = at.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ends.unionByName(at.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and text of the rows whose id may be among the ``wanted`` ones (id); a bit table keeps most others out."""
    table = bit_table(wanted.select(F.xxhash64("id").alias("key")).distinct())
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return texts.filter(marked(table.scalar(), F.xxhash64("id")))


def _verified(docs: DataFrame, pairs: DataFrame, name: str, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) that are linked, counted on the full sets.

    A text with many partners meets them in groups of at most about ``TOGETHER`` characters, so
    it travels once a group, not once a pair, and no group is larger for its being hot. (Each
    pair has the size of its longer text.)
    """
    load = pairs.groupBy("a").agg(F.sum("size").alias("load")).withColumn("parts", F.ceil((F.col("load") + 1) / TOGETHER).cast("int"))
    dealt = landed(pairs.join(load, "a").select("a", "b", F.pmod(F.xxhash64(F.lit(5), "b"), F.col("parts")).cast("int").alias("part")), name + "-dealt")
    members = dealt.select("a", "part", F.col("b").alias("id"), F.lit(False).alias("own")).unionByName(
        dealt.select("a", "part", F.col("a").alias("id"), F.lit(True).alias("own")).distinct())
    groups = members.join(_texts(docs, members, id_col, text_col), "id").select("a", "part", "id", "own", "text").groupBy("a", "part")
    return landed(groups.applyInArrow(lambda group: _alike(group, width, percent), "a long, b long"), name + "-links")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ``sets`` whose registers make a link likely."""
    left, right = (sets.select(F.col("id").alias(x), F.col("n").alias("n" + x), F.col("sketch").alias("s" + x), F.col("size").alias("z" + x)) for x in "ab")
    full = pairs.join(right, "b").join(left, "a").select("a", "b", "na", "nb", "sa", "sb", F.greatest("za", "zb").alias("size"))
    return landed(full.mapInArrow(tidied(_likely, percent=percent), "a long, b long, size long"), "likely")


def _star_links(pairs: DataFrame, link) -> tuple[DataFrame, DataFrame]:
    """Links among the star pairs (a, b), and the components (id, component) that they form.

    ``link`` gives the linked ones of some pairs. In a round every set meets its smallest
    firsts, ``PARTNERS`` of them; the last round takes all that are left. A pair is left out
    only once its ends are in one component.
    """
    links = found = None
    smallest = F.row_number().over(Window.partitionBy("b").orderBy("a"))  # at most a row for each band
    for most in (*PARTNERS, None):
        ranked = pairs if most is None else landed(pairs.withColumn("k", smallest), "star-round")
        new = link(ranked if most is None else ranked.filter(F.col("k") <= most).select("a", "b"))
        links = new if links is None else links.unionByName(new)
        found = landed(components(links), "components")
        if most is not None:
            ends = [found.select(F.col("id").alias(x), F.col("component").alias("c" + x)) for x in "ab"]
            left = ranked.filter(F.col("k") > most).join(ends[0], "a", "left").join(ends[1], "b", "left")
            pairs = landed(left.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"), "star-pairs")
            if pairs.isEmpty():
                break
    return links, found


def near_duplicate_classes(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Two rows are linked if 100 * shared shingles >= ``percent`` * all shingles of both,
    counted on the full sets. ``component_id`` is the smallest id that links lead to.
    Null, empty and blank texts have an empty set and link with nothing. Rows with equal
    ids are one class. A row without an id is its own class: component_id null, kept.
    """
    seen = landed(sketches(docs, width, id_col, text_col), "sketches")
    known = seen.filter("n > 0 AND doc_id IS NOT NULL")
    sets = landed(known.groupBy("digest", "n").agg(F.min_by(F.struct("doc_id", "size", "sketch"), "doc_id").alias("s"))
                  .select(F.col("s.doc_id").alias("id"), "n", "s.size", F.col("s.sketch").alias("sketch"), "digest"), "sets")
    rows = (sets.select("id", "n", "sketch").mapInArrow(tidied(_keys), "id long, n long, keys array<bigint>")
            .select("id", "n", F.explode("keys").alias("key")))
    buckets = landed(rows.groupBy("key").agg(F.min_by(F.struct("id", "n"), "id").alias("s"), F.max("id").alias("last"), F.count("*").alias("size"))
                     .select("key", F.col("s.id").alias("first"), F.col("s.n").alias("first_n"), "last", "size").filter("first != last"), "buckets")
    members = landed(rows.join(buckets, "key"), "members")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        return _verified(docs, pairs, name, width, percent, id_col, text_col)

    # Sets whose sizes alone forbid a link are not compared.
    fits = "100 * least(n, first_n) >= %d * greatest(n, first_n)" % percent
    stars = members.filter("id != first").filter(fits).select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    links, found = _star_links(landed(stars, "star-pairs"), lambda some: verified(_compared(some, sets, percent), "stars"))
    joined = members.filter("size > 2").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    firsts = found.select(F.col("id").alias("first"), F.col("component").alias("_c"))
    joined = joined.join(firsts, "first", "left").withColumn("outside", F.col("component") != F.coalesce("_c", "first"))
    # Members besides the first one, in buckets that hold several components.
    rest = landed(joined.filter("id != first").select("key", "id", "n", "component", "outside"), "rest")
    crowds = rest.groupBy("key").agg(F.count_if("outside").alias("_o"), F.count("*").alias("_m"), F.sum(F.when(F.col("outside"), F.col("n"))).alias("_no"),
                                     F.sum("n").alias("_nm")).filter("_o > 0 AND _m > 1")
    # A bucket becomes blocks of at most about BLOCK outsiders and BLOCK members, fewer where the sets are large.
    parts = {f"_{x}": F.ceil(F.greatest(F.col(f"_{x}") / BLOCK, F.col(f"_n{x}") / BLOCK_MEMBERS)).cast("int") for x in "om"}
    rest = landed(rest.join(crowds, "key").withColumns(parts).drop("_no", "_nm"), "crowds")
    # The sets themselves travel with their registers, so that only links leave a block.
    wanted = rest.select("id").distinct()
    full = _texts(docs, wanted, id_col, text_col).join(wanted, "id").select("id", "text").mapInArrow(tidied(_hashed, width=width), "id long, digest binary, hashes binary")
    full = landed(full.dropDuplicates(["id", "digest"]).join(sets.select("id", "digest", "sketch"), ["id", "digest"]).drop("digest"), "crowd-sets")
    own = F.xxhash64(F.lit(3), "id")
    as_member = rest.withColumn("outside", F.lit(False)).withColumn("_y", F.pmod(own, "_m").cast("int")).withColumn("_x", F.explode(F.sequence(F.lit(0), F.col("_o") - 1)))
    as_outsider = rest.filter("outside").withColumn("_x", F.pmod(own, "_o").cast("int")).withColumn("_y", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
    blocks = as_member.unionByName(as_outsider.select(as_member.columns)).join(full, "id")
    links_in = blocks.select("key", "_x", "_y", "id", "n", "component", "outside", "sketch", "hashes").groupBy("key", "_x", "_y") \
        .applyInArrow(lambda block: _block_links(block, percent), "a long, b long")
    more = landed(links_in.distinct(), "crossing")
    # Ids that occur with several sets join those.
    several = known.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).filter("x != y").select("doc_id")
    same_id = known.join(several, "doc_id").join(sets.select("digest", "n", "id"), ["digest", "n"]).select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    final = landed(components(links.unionByName(more).unionByName(same_id)), "components")
    # Rows of equal sets follow their set's first row.
    by_set = sets.join(final, "id", "left").select("digest", "n", F.coalesce("component", "id").alias("component"))
    rows = seen.join(by_set, ["digest", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are the first of their class; of rows with equal ids
    and equal verdicts all stay or go together."""
    gone = near_duplicate_classes(docs, width, percent, id_col, text_col).filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    gone = landed(gone, "gone")
    return docs.join(gone, docs[f"`{id_col}`"] == gone["_gone"], "left_anti")
