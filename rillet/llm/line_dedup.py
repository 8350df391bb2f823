"""Line dedup by a deletion-neighbourhood join: lines one word apart count as the same, the earliest stays.

The unit of an edit is a word; in scripts that are written without blanks it is a character.
Every line that is not blank takes part: equal ones count as the same whatever their
length, lines of 8 words or more also with one edit. A line emits hashed keys of all its variants with one
word deleted; lines that share a variant are candidates, their edit distance is
verified, and a line goes if an earlier one lies within the bound. Two kinds of keys
make this exact without pairing all lines of a key:

* substitution: the words before and after the deleted one, and the word count. All
  lines of such a key lie within one substitution of each other, so each is compared with the earliest only.
* insertion: the same words, met by the line that consists of just them. That line is
  compared with every line of the key, and no other two.

Before that, equal lines are one line; and since one edit leaves the first or the last
half of a line as it is, only lines that share a half with another line need variants,
and only those with the word deleted outside that half. Shared halves are looked up in
a bit table sized by their number, which may let lines through in vain but never loses
one, and then joined: what lines emit grows with the halves that they do share.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import bit_table, landed, let, marked, table_bits

#: Lines from so many words on are also compared with one edit.
NEAR_WORDS = 8
#: White space between words.
_BLANKS = " \t\n\x0b\f\r"
#: A character of a script that is written without blanks; all of them come after _LATE, which costs less to look for.
_LATE = r"[\x{0E00}-\x{10FFFF}]"
_UNSPACED = "[" + "".join(rf"\p{{Is{x}}}" for x in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")) + "]"


def _split_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, line_no (from 0), line."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def _lines(rows: DataFrame) -> DataFrame:
    """doc_id, line_no, t (the line's words parted by single blanks), c (their count) of the lines that are not blank.

    Characters of scripts without blanks are words of their own. Each step is a column, so that none is computed twice.
    """
    line, trimmed = F.col("line"), F.col("_trimmed")
    unspaced = (F.octet_length(line) > F.char_length(line)) & line.rlike(_LATE) & line.rlike(_UNSPACED)
    spaced = F.when(unspaced, F.regexp_replace(line, f"({_UNSPACED})", " $1 ")).otherwise(line)
    lines = rows.filter(F.btrim(line, F.lit(_BLANKS)) != "").select("doc_id", "line_no", F.btrim(spaced, F.lit(_BLANKS)).alias("_trimmed"))
    odd = functools.reduce(operator.or_, [F.contains(trimmed, F.lit(x)) for x in ("  ", *_BLANKS[1:])])
    lines = lines.select("doc_id", "line_no", F.when(odd, F.regexp_replace(trimmed, f"[{_BLANKS}]+", " ")).otherwise(trimmed).alias("t"))
    return lines.withColumn("c", F.octet_length("t") - F.octet_length(F.replace("t", F.lit(" "), F.lit(""))) + 1)


def _identity(t: Column) -> list[Column]:
    """Two independent 64-bit hashes name a line."""
    return [F.xxhash64(t).alias("h1"), F.xxhash64(F.lit(1), t).alias("h2")]


def _word_hashes(t: Column) -> Column:
    return F.transform(F.split(t, " "), lambda x: F.xxhash64(x))


def _halves(t: Column, words: Column) -> list[Column]:
    """Keys of the first and last half, as a line of its length and as the longer of two."""
    out = []
    for shorter in (0, 1):
        n = words - shorter
        k = F.floor(n / 2).cast("int")
        out.append(F.xxhash64(F.lit(2), n, F.call_function("substring_index", t, F.lit(" "), k)))
        out.append(F.xxhash64(F.lit(3), n, F.call_function("substring_index", t, F.lit(" "), k - n)))
    return [F.when(words >= NEAR_WORDS, c) for c in out]


#: Words whose hashes make one link of the chain below.
_LINK = 32


def _running(w: Column) -> Column:
    """Hashes of the first 0, 1, .. n words. A chain of hashes runs over whole links of words; the
    words after the last whole link are hashed with its value, so long lines cost no square of work."""
    def chain(links):
        return F.aggregate(links, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.xxhash64(F.element_at(acc, -1), x))))

    def after(values):
        def of(k):
            whole = F.shiftright(k, 5)
            return F.xxhash64(F.get(values, whole), F.slice(w, whole * _LINK + 1, k.bitwiseAND(F.lit(_LINK - 1))))
        return F.transform(F.sequence(F.lit(0), F.size(w)), of)
    links = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(w), 5)), lambda b: F.xxhash64(F.slice(w, b * _LINK + 1, F.lit(_LINK))))
    return let(chain(links), after)


def _split_keys(w: Column, half: Column) -> Column:
    """Keys of a line's edits outside a half (part, key, swap, cut) that it shares; the half goes by its key, which holds the word count:
    swap: for each word of the rest, of the words before and after it, to meet lines of that word count;
    cut: the same as the longer of two lines, which names the line without that word;
    gap: for each gap of the rest, of the words before and after it, which names the line itself."""
    n, part, key = F.size(w), half["part"], half["key"]
    of_two = F.when(part < 2, n).otherwise(n - 1)  # words of the shorter line
    k = F.shiftright(of_two, 1)
    rest = F.when(part % 2 == 0, F.slice(w, k + 1, n - k)).otherwise(F.slice(w, F.lit(1), n - of_two + k))
    none = F.array().cast("array<bigint>")

    def keys(before, after):
        m = F.size(before) - 1
        words = F.transform(F.sequence(F.lit(1), m), lambda i: F.xxhash64(key, F.get(before, i - 1), F.get(after, m - i)))
        gaps = F.transform(F.sequence(F.lit(0), m), lambda i: F.xxhash64(key, F.get(before, i), F.get(after, m - i)))
        return F.struct(F.when((part < 2) & half["swap"], words).otherwise(none).alias("swap"), F.when(part >= 2, words).otherwise(none).alias("cut"),
                        F.when((part < 2) & half["cut"], gaps).otherwise(none).alias("gap"))

    def both(x):  # words and reversed words, bound
        return let(_running(x["w"]), lambda before: let(_running(x["r"]), lambda after: keys(before, after)))
    return let(rest, lambda r: let(F.struct(r.alias("w"), F.reverse(r).alias("r")), both))


def _place(doc: Column, line: Column) -> Column:
    """One number that orders lines by (id, line number)."""
    return (doc.cast("decimal(19,0)") * F.lit(1 << 31).cast("decimal(10,0)") + line.cast("decimal(10,0)")).cast("decimal(38,0)")


def _edits_within_one(a: Column, b: Column) -> Column:
    """Whether word arrays lie at most one insertion, deletion or substitution apart."""
    def equal_run(x, y):
        differing = F.array_position(F.transform(F.arrays_zip(x.alias("x"), y.alias("y")), lambda z: F.coalesce(z["x"] == z["y"], F.lit(False))), False)
        return F.when(differing == 0, F.least(F.size(x), F.size(y))).otherwise(differing - 1)
    run = equal_run(a, b) + equal_run(F.reverse(a), F.reverse(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (run >= F.greatest(F.size(a), F.size(b)) - 1)


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, line_no, near of every line to drop: an earlier line, by (id, line number), is equal or
    (``near``) one word apart. Blank lines are never dropped, lines under 8 words only as equal ones."""
    t = F.col("t")
    seen = landed(_lines(_split_lines(docs, id_col, text_col)).select(
        "doc_id", "line_no", *_identity(t), *[k.alias(f"k{i}") for i, k in enumerate(_halves(t, F.col("c")))]), "lines")
    lines = landed(seen.groupBy("h1", "h2").agg(F.min(_place(F.col("doc_id"), F.col("line_no"))).alias("first"), F.count("*").alias("n"),
                                                *[F.max(f"k{i}").alias(f"k{i}") for i in range(4)]), "distinct-lines")
    # Parts 0 and 1 are a line's own halves, 2 and 3 those that it has as the longer of two: two such alone are no match.
    halves = lines.select("first", "h1", "h2", F.posexplode(F.array("k0", "k1", "k2", "k3")).alias("part", "key")).filter("key IS NOT NULL")
    shared = halves.groupBy("key").agg(F.count_if(F.col("part") < 2).alias("own"), F.count_if(F.col("part") >= 2).alias("longer")).filter("own > 0 AND own + longer > 1")
    shared = landed(shared.select("key", F.expr("own > 1").alias("swap"), F.expr("longer > 0").alias("cut")), "shared-halves")
    bits = table_bits(shared.count())
    wanted = halves.filter(marked(bit_table(shared, bits).scalar(), F.col("key"), bits)).join(shared.hint("merge"), "key").filter("part < 2 OR cut")
    wanted = landed(wanted.groupBy("first", "h1", "h2").agg(F.collect_list(F.struct("part", "key", "swap", "cut")).alias("halves")), "near-candidates")
    # Fetch the words of the candidates: two more bit tables, of their documents and of their places, spare the other texts.
    line_no = F.pmod(F.col("first"), F.lit(1 << 31).cast("decimal(10,0)")).cast("decimal(10,0)")
    places = wanted.select(((F.col("first") - line_no) / F.lit(1 << 31).cast("decimal(10,0)")).cast("long").alias("doc_id"), line_no.cast("int").alias("line_no"))
    bits = table_bits(wanted.count())
    in_docs = bit_table(places.select(F.xxhash64("doc_id").alias("key")), bits).scalar()
    in_places = bit_table(places.select(F.xxhash64("doc_id", "line_no").alias("key")), bits).scalar()
    again = _split_lines(docs.filter(marked(in_docs, F.xxhash64(F.col(f"`{id_col}`").cast("long")), bits)), id_col, text_col)
    again = _lines(again.filter(marked(in_places, F.xxhash64("doc_id", "line_no"), bits)))
    near = again.select(*_identity(F.col("t")), _word_hashes(F.col("t")).alias("w")).groupBy("h1", "h2").agg(F.first("w").alias("w"))
    # From here on a line goes by its first place.
    near = near.join(wanted, ["h1", "h2"]).select("first", "w", F.transform("halves", lambda half: _split_keys(F.col("w"), half)).alias("k"))
    near = landed(near.select("first", "w", *[F.flatten(f"k.{x}").alias(x) for x in ("swap", "cut", "gap")]), "near-lines")
    # Substitution: each line of a key against the earliest.
    swaps = near.select("first", F.explode("swap").alias("key"))
    earliest = swaps.groupBy("key").agg(F.min("first").alias("b"), F.max("first").alias("_last")).filter("b != _last").drop("_last")
    pairs = swaps.join(earliest, "key").filter("first != b").select(F.col("first").alias("a"), "b")
    # Insertion: the line that a key names against the lines that have one word more.
    cuts = near.select(F.col("first").alias("a"), F.explode("cut").alias("key"))
    gaps = near.select(F.col("first").alias("b"), F.explode("gap").alias("key"))
    pairs = landed(pairs.unionByName(cuts.join(gaps, "key").select("a", "b")).distinct(), "line-pairs")
    a, b = (near.select(F.col("first").alias(x), F.col("w").alias(x + "w")) for x in "ab")
    close = pairs.hint("merge").join(a, "a").join(b, "b").filter(_edits_within_one(F.col("aw"), F.col("bw")))
    gone = landed(close.select(F.greatest("a", "b").alias("first")).distinct(), "near-ones")
    bits = table_bits(gone.count())
    in_gone = marked(bit_table(gone.select(F.xxhash64("first").alias("key")), bits).scalar(), F.xxhash64("first"), bits)
    verdicts = lines.filter((F.col("n") > 1) | in_gone).join(gone.withColumn("near", F.lit(True)).hint("merge"), "first", "left").filter("n > 1 OR near").select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    verdicts = landed(verdicts, "line-verdicts")
    return (seen.select("doc_id", "line_no", "h1", "h2").join(verdicts, ["h1", "h2"])
            .filter(F.col("near") | (_place(F.col("doc_id"), F.col("line_no")) != F.col("first"))).select("doc_id", "line_no", "near"))


def _kept(text: Column, dropped: Column) -> Column:
    """The text without the lines of the given numbers: what lies between them, one slice each."""
    def between(x: Column) -> Column:
        at, lines = x["at"], x["lines"]
        return F.flatten(F.transform(F.sequence(F.lit(1), F.size(at) - 1), lambda k: F.slice(lines, F.get(at, k - 1) + 2, F.get(at, k) - F.get(at, k - 1) - 1)))

    def bounds(lines: Column) -> Column:
        return F.struct(lines.alias("lines"), F.concat(F.array(F.lit(-1)), F.sort_array(dropped), F.array(F.size(lines))).alias("at"))
    return F.array_join(let(let(F.split(text, "\n"), bounds), between), "\n")


def _dropped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, lines, near: numbers of a document's own lines to drop, and how many of them are near ones."""
    found = repeated_lines(docs.filter(F.col(f"`{id_col}`").isNotNull()), id_col, text_col)
    return found.groupBy("doc_id").agg(F.collect_set("line_no").alias("lines"), F.count_if("near").alias("near"))


def _with_dropped(rows: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rows`` (doc_id and more) with lines and near of their document, nulls where it loses none. Texts are
    shuffled to their line numbers; a bit table of the documents that lose lines spares it the other texts. The join is a
    merge join at every size: the line numbers grow with the documents and are no thing to broadcast."""
    dropped = landed(_dropped(docs, id_col, text_col), "dropped-lines")
    bits, key = table_bits(dropped.count()), F.xxhash64("doc_id")
    loses = marked(bit_table(dropped.select(key.alias("key")), bits).scalar(), key, bits)
    whole = rows.filter(~loses).select("*", *[F.lit(None).cast(dropped.schema[c].dataType).alias(c) for c in ("lines", "near")])
    return rows.filter(loses).join(dropped.hint("merge"), "doc_id", "left").unionByName(whole)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_equal, n_near, kept_text of every row.

    Null texts have no lines and stay null; an empty text is one empty line. Among rows
    with equal ids the line number decides, and lines dropped from one of them are
    dropped from all; rows without an id come first and lose nothing. An empty table
    gives no rows. A line never meets more than its key's earliest line, so a hot line,
    key or source is counted before it is shuffled and never gathered in one task.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    gone, near = F.coalesce(F.size("lines"), F.lit(0)), F.coalesce("near", F.lit(0))
    return (_with_dropped(rows, docs, id_col, text_col)
            .select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
                    (gone - near).cast("long").alias("n_equal"), near.cast("long").alias("n_near"),
                    F.when(gone == 0, F.col("text")).otherwise(_kept(F.col("text"), F.col("lines"))).alias("kept_text")))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with the text left after line dedup. A document that
    loses lines goes if only blank ones are left: any other may be the earliest copy, and the
    only one kept. Columns may have any names."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col("row")[id_col].cast("long").alias("doc_id"))
    joined = _with_dropped(rows, docs, id_col, text_col)
    text = F.col("row")[text_col]
    joined = joined.select("row", "lines", F.when(F.col("lines").isNull(), text).otherwise(_kept(text, F.col("lines"))).alias("kept"))
    left = joined.filter(F.col("lines").isNull() | (F.btrim("kept", F.lit(_BLANKS)) != ""))
    return left.select(*[(F.col("kept") if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
