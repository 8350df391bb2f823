"""Periodic runs, spelling variants and source mixing against brute force."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillet.llm import mixing, queries, runs, spelling
from rillet.llm.oracle import ORACLES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def all_runs(w):
    """Runs of at least four periods and six words, by trying every period at every place."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(6, 4 * q) and not any(all(w[x] == w[x + d] for x in range(i, i + size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def collapsed(w, found):
    return " ".join(x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in found))


def repeating_text(r):
    n = r.choice([0, 1, 4, 5, 6, 7, 15, 40, 100, 300])
    letters = r.choice([1, 2, 3, 8, 60])
    w = [f"w{r.randrange(letters)}" for _ in range(n)]
    for _ in range(r.randrange(4) if n else 0):
        s, p = r.randrange(n), r.randrange(1, max(2, n // 4))
        for i in range(s + p, min(n, s + int(p * r.uniform(2, 12)))):
            w[i] = w[s + (i - s) % p]
        if r.random() < 0.3:
            w[r.randrange(n)] = "other"
    return w


def test_runs_equal_all_periods(make_docs):
    r = random.Random(5)
    texts = [repeating_text(r) for _ in range(400)]
    # Runs inside runs: a short period repeated inside a long one, at several scales.
    inner = ["a", "b"] * 5 + ["c"]
    texts += [inner * 6, (inner * 5 + ["d"]) * 4, ["x"] * 5, ["x"] * 6, ["x", "y"] * 4, (["x", "y"] * 4)[:7]]
    docs = make_docs([" ".join(w) for w in texts] + [None, "", " \t\n", "one"])
    got = {x["doc_id"]: x for x in runs.periodic_runs(docs).collect()}
    assert len(got) == len(texts) + 4
    for i, w in enumerate(texts):
        want = all_runs(w)
        assert [tuple(x) for x in got[i]["runs"]] == want
        assert got[i]["collapsed"] == collapsed(w, want) and got[i]["n_words"] == len(w)
    assert max(q for x in got.values() for _, _, q in x["runs"]) >= 4 * runs.FIRST_SCALE  # several scales were needed
    assert [(got[len(texts) + k]["n_words"], got[len(texts) + k]["collapsed"]) for k in range(4)] == [(0, ""), (0, ""), (0, ""), (1, "one")]


def test_runs_in_long_texts_repeated_rows_and_any_grouping(make_docs, monkeypatch):
    """A period of thousands of words, in a text larger than a group; rows that repeat; no-break spaces are no white space."""
    r = random.Random(6)
    unit = [f"u{r.randrange(500)}" for _ in range(5000)]
    long = [f"v{k}" for k in range(777)] + unit * 4 + unit[:3] + ["end"]
    docs = make_docs([(7, " ".join(long)), (7, " ".join(long)), (8, "a b " * 6), (None, "q " * 9)])
    for size in (1, runs.GROUP_BYTES):
        monkeypatch.setattr(runs, "GROUP_BYTES", size)
        got = sorted((x["doc_id"] or 0, [tuple(y) for y in x["runs"]], x["collapsed"]) for x in runs.periodic_runs(docs).collect())
        assert got == [(0, [(0, 9, 1)], "q"), *[(7, [(777, 20003, 5000)], " ".join([*long[:5777], "end"]))] * 2, (8, [(0, 6, 1)], "a b")]


def test_runs_of_no_rows(make_docs):
    out = runs.periodic_runs(make_docs([]))
    assert out.collect() == [] and out.columns == ["doc_id", "n_words", "runs", "collapsed"]


def test_runs_of_a_batch_hold_one_group_at_a_time():
    """A batch of 12 MB: Python objects and arrays stay within 40 times a group of 1 MB (over 100 MB when all words were objects),
    and Arrow holds the group and its results beside the batch."""
    r = random.Random(9)
    body = [" ".join(f"w{r.randrange(5000)}" for _ in range(480)) for _ in range(50)]
    texts = [f"{body[k % 50]} n{k}" + " x y" * 8 for k in range(4200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    arrow, most, rows = pa.total_allocated_bytes(), 0, 0
    tracemalloc.start()
    try:
        for out in runs._batches(iter([batch])):
            most = max(most, pa.total_allocated_bytes() - arrow)
            assert out.column(2).to_pylist() == [[{"start": 481, "length": 16, "period": 2}]] * len(out)
            assert out.column(3).to_pylist() == [f"{body[k % 50]} n{k} x y" for k in range(rows, rows + len(out))]
            assert set(out.column(1).to_pylist()) == {497}
            rows += len(out)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == len(texts) and batch.nbytes > 10 << 20
    assert peak < 40 << 20 and most < 8 << 20


def test_words_are_cut_as_the_contract_says():
    """Only 09 to 0D and 20 part words; words end with their texts; texts may be empty or blank, and a slice of others."""
    r = random.Random(10)
    parts = ["a", "b", "\x08", "\x0e", "\x1c", "\x85", "\u00a0", "\u65e5\u672c", " ", "\t", "\n", "\x0b", "\x0c", "\r"]
    texts = ["", " ", "a", *("".join(r.choice(parts) for _ in range(r.randrange(30))) for _ in range(300)), "", "b"]
    words, counts = runs._words(pa.array([t.encode() for t in texts], pa.large_binary()).slice(2, 301))
    want = [WORD.findall(t) for t in texts[2:303]]
    assert counts.tolist() == [len(w) for w in want] and [w.decode() for w in words.to_pylist()] == [x for w in want for x in w]
    assert [x.tolist() for x in runs._words(pa.array([b"", b""], pa.large_binary()))[1:]] == [[0, 0]]


def test_op11_takes_few_texts_at_a_time(spark):
    """By default the reader takes 4096 whole texts at a time and a worker 10000, which cost an executor hundreds of MB."""
    most = {"spark.sql.parquet.columnarReaderBatchSize": 512, "spark.sql.execution.arrow.maxRecordsPerBatch": 1000}
    for key in most:
        spark.conf.set(key, 10000)
    queries.op11_periodic_runs(spark, SMALL)
    assert {key: int(spark.conf.get(key)) for key in most} == most


def test_op11_equals_its_contract(spark):
    """The whole query on the small table: planted repeats, the best run and both digests."""
    got = {x["doc_id"]: x for x in queries.op11_periodic_runs(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted = 0
    for i, text in docs:
        w, h = WORD.findall(text or ""), zlib.crc32(str(i).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w, planted = w[:a] + [w[a + (k - a) % p] for k in range(a, n)], planted + 1
        if n > 2500:
            continue  # trying every period takes too long; such texts are covered above
        found = all_runs(w)
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert tuple(got[i][1:6]) == (len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2])
        assert got[i]["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert got[i]["collapsed_sha256"] == hashlib.sha256(collapsed(w, found).encode()).hexdigest()
    assert planted > 5 and sum(x["n_runs"] for x in got.values()) > 5


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def variants(counts):
    """word -> (form, root, n, n_near, form_n), by comparing all pairs."""
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        top = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = top if top and counts[top] >= 10 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {w: (form[w], root(w), n, len(near[w]), form[w] and counts[form[w]]) for w, n in counts.items()}


def table(df):
    return {x["word"]: tuple(x)[1:] for x in df.collect()}


def test_variants_equal_all_pairs(spark):
    r = random.Random(2)
    words = set()
    for _ in range(60):
        w = "".join(r.choice("abà") for _ in range(r.randrange(1, 12)))
        for _ in range(8):  # chains of edits around it, with stretches of equal letters
            k = r.randrange(len(w) + 1)
            w = r.choice([w[:k] + r.choice("abà") + w[k:], w[:k] + w[k + 1:], w[:k] + "b" + w[k + 1:]])
            words.add(w)
    words |= {"a" * k for k in range(1, 9)} | {"ab", "ba", "b"}
    words.discard("")
    counts = {w: r.choice([2, 2, 3, 25, 300, 3000, 40000]) for w in sorted(words)}
    got = table(spelling.group_variants(spark.createDataFrame(sorted(counts.items()), "word string, n long").repartition(5)))
    assert got == variants(counts)
    assert any(f and r != f for f, r, *_ in got.values())  # some chains have two steps


def test_variants_of_any_words(spark):
    """Very long words, code points beyond 16 bits, ties, null words, and no words."""
    long = "".join(random.Random(1).choice("abcdefgh") for _ in range(3000))
    counts = {long: 50, long[:1500] + "z" + long[1500:]: 2, long[:-1]: 50, "\U0001F600aaaaaa": 20, "\U0001F601aaaaaa": 20, "xaaaaaa": 2, "alone": 7}
    rows = [*counts.items(), (None, 9)]
    assert table(spelling.group_variants(spark.createDataFrame(rows, "word string, n long"))) == variants(counts)
    assert spelling.group_variants(spark.createDataFrame([], "word string, n long")).collect() == []


def test_words_and_counts(make_docs):
    docs = make_docs([(1, "Straße STRASSEN straßen, ÀÈÌÒÙÂÊ-abcdefg 1abcdefg2"), (2, None), (2, ""), (None, "STRASSEN strassen"), (4, "Àbcdefgh Àbcdefgh")])
    got = Counter(x["word"] for x in spelling.words_of(docs).collect())
    assert got == Counter({"strassen": 3, "straßen": 1, "ÀÈÌÒÙÂÊ": 1, "abcdefg": 2, "Àbcdefgh": 2})
    assert {tuple(x) for x in spelling.count_words(spelling.words_of(docs)).collect()} == {("strassen", 3), ("abcdefg", 2), ("Àbcdefgh", 2)}
    assert spelling.words_of(make_docs([])).collect() == []


def test_op12_equals_its_contract(spark):
    counts = Counter()
    for i, text in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    # All pairs of thousands of words would take too long: the words without each letter are looked up.
    keys = defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            keys[w[:k], w[k + 1:]].add(w)
    near = {w: set() for w in counts}
    for (p, s), ws in keys.items():
        whole = {p + s} & counts.keys()
        for w in ws:
            near[w] |= (ws | whole) - {w}
        for w in whole:
            near[w] |= ws
    got = table(queries.op12_spelling_variants(spark, SMALL))
    assert {w: (x[2], x[3]) for w, x in got.items()} == {w: (n, len(near[w])) for w, n in counts.items()}
    for w, (form, _, n, _, form_n) in got.items():
        top = min(near[w], key=lambda x: (-counts[x], x), default=None)
        assert (form, form_n) == ((top, counts[top]) if top and counts[top] >= 10 * n else (None, None))


def shares(sizes, weights=(5, 2, 1), percent=150, most=2):
    """Targets by source: shared by weight, stopped at ``most`` times a size, the excess shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, stopped = percent / 100 * sum(sizes.values()), set()
    while True:
        level = (budget - sum(most * sizes[s] for s in stopped)) / (sum(w[s] for s in order if s not in stopped) or 1)
        more = {s for s in order if s not in stopped and most * sizes[s] < level * w[s]}
        if not more:
            return {s: most * sizes[s] if s in stopped else level * w[s] for s in order}
        stopped |= more


def test_mix_meets_targets(make_docs):
    """Hot, tiny, null and wordless sources, null ids, repeated rows, ties, huge documents."""
    r = random.Random(3)
    rows = []
    for k in range(3000):
        source = "hot" if k % 3 == 0 else r.choice(["a", "b", "c", "d", None])
        rows.append((k if k % 50 else None, "w " * (r.choice([1, 5, 30, 100, 2000]) if source != "tiny" else 3), source))
    rows += [(k, "", "blank") for k in range(4)] + [(9000 + k // 2, "x y z", "tiny") for k in range(8)] + [(5, None, "b")]
    docs = make_docs([x[:2] for x in rows]).drop("source").withColumn("source", F.lit(None).cast("string"))
    docs = docs.sparkSession.createDataFrame([(i, t, s) for i, t, s in rows], "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("key", F.lit(1))
    out = mixing.mix_sources(docs)
    got = out.collect()
    assert len(got) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for x in got:
        sizes[x["source"]] += x["size"]
        taken[x["source"]] += x["taken"]
        target[x["source"]] = x["target"]
        assert x["taken"] == x["copies"] * x["size"] and 0 <= x["copies"] <= 2
    assert sizes == Counter({s: sum(len((t or "").split()) for _, t, y in rows if y == s) for s in {x[2] for x in rows}})
    want = shares(dict(sizes))
    for s in sizes:
        # No document that is left would bring a source nearer: it misses by half of the shortest one at most.
        whole = int(want[s] // sizes[s]) if sizes[s] else 0
        left = min((x["size"] for x in got if x["source"] == s and x["size"] and x["copies"] == whole), default=0)
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= max(3, 0.002 * want[s], left / 2)
    assert all(x["source_size"] == sizes[x["source"]] for x in got)
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert mixing.mix_sources(docs.limit(0)).collect() == []


def test_inclusion_follows_the_target(spark):
    """Over many draws of ids the share of documents taken once more is the source's share, whatever the size."""
    docs = spark.range(20000).selectExpr("id * 7919 + 13 AS doc_id", "repeat('w ', CAST(1 + id % 9 AS INT)) AS text", "IF(id % 4 = 0, 'a', 'b') AS source")
    got = mixing.mix_sources(docs).toPandas()
    for _, part in got.groupby("source"):
        share = part["target"].iloc[0] / part["source_size"].iloc[0]
        for _, same in part.groupby("size"):
            assert abs(same["copies"].mean() - share) < 4 * np.sqrt(0.25 / len(same))


@pytest.mark.parametrize("name", ["op12_spelling_variants", "op13_source_mixing"])
def test_sql_of_the_new_queries(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    found = con.execute(ORACLES[name])
    at = [[d[0] for d in found.description].index(c) for c in df.columns]
    want = [tuple(row[k] for k in at) for row in found.fetchall()]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))
