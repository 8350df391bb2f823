"""Sharding, fingerprints, quality rules, licences, byte-level BPE against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillet.llm import bpe, fingerprints, licenses, quality, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [None, "", "   \n\t ", "one", "one two three four five", "a" * 5000, "Zoë’s naïve 日本語 text", "same text", "same text", "x " * 20000]


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"]))


def jump(key, n):
    b, j = -1, 0
    key &= (1 << 64) - 1
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_shard_follows_the_published_loop(spark):
    keys = [0, 1, -1, 256, 2**63 - 1, -(2**63), 1234567890123456789]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 100):
        got = {r["k"]: r["s"] for r in df.select("k", sharding.jump_shard(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k, n) for k in keys}


def test_shards_move_only_into_the_new_one(spark, small_docs, make_docs):
    got = rows(sharding.shard_rows(small_docs, 8))
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    for r in got:
        assert r["grown_shard"] in (r["shard"], 8) and r["law"] == "key"
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    edge = rows(sharding.shard_rows(make_docs([*EDGE, (3, "again"), (None, "no id"), (None, None)])))
    assert len(edge) == len(EDGE) + 3 and edge[0]["size"] == 1 and edge[0]["text_crc32"] == 0
    assert sharding.shard_rows(make_docs([])).count() == 0


def test_shards_are_written_whole(spark, small_docs, tmp_path):
    sharding.write_shards(small_docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == small_docs.count() and {r[0] for r in back.select("_shard").distinct().collect()} == {0, 1, 2, 3}


def shingles(t):
    w = WORD.findall(t or "")
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_fingerprints_estimate_resemblance(spark, small_docs):
    docs = sorted((r["doc_id"], r["text"]) for r in small_docs.collect())
    got = rows(fingerprints.fingerprint_documents(small_docs))
    errors = []
    for k, ((i, t), r) in enumerate(zip(docs, got, strict=True)):
        after, half = docs[(k + 1) % len(docs)][1], len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        assert r["doc_id"] == i and r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for other, key in ((edited, "near_edited"), (after, "near_next")):
            a, b = shingles(t), shingles(other)
            errors.append((len(a), r[key] - len(a & b) / max(1, len(a | b))))
    # Sets smaller than the bins carry no more than their own sampling error.
    many = [e for n, e in errors if n >= 100]
    assert len(many) > 200 and abs(np.mean(many)) < 0.01 and np.std(many) < 0.035 and np.std([e for _, e in errors]) < 0.08


def test_fingerprint_edges(spark, make_docs):
    got = rows(fingerprints.fingerprint_documents(make_docs([*EDGE, (3, "one")])))
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(EDGE) + 1 and by_id[0]["n_chars"] == 0 and by_id[0]["near_next"] == 1.0
    assert by_id[7]["fingerprint"] == by_id[8]["fingerprint"] and by_id[7]["near_next"] == 1.0
    assert len({r["fingerprint"] for r in got if r["doc_id"] < 3}) == 1
    assert rows(fingerprints.fingerprint_documents(make_docs(["alone here"])))[0]["near_next"] == 1.0
    assert fingerprints.fingerprint_documents(make_docs([])).count() == 0
    nulls = fingerprints.fingerprint_documents(make_docs([(None, "b"), (None, "a"), (1, "c")])).collect()
    assert {r["edited_sha256"] for r in nulls} == {hashlib.sha256(x.encode()).hexdigest() for x in ("b", "a", "c")}


def test_successors_cross_range_borders(spark):
    df = spark.range(0, 1000).repartition(7).select((F.col("id") * 3).alias("doc_id"), F.col("id").cast("string").alias("text"))
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(df, ["text"]).collect()}
    assert got == {3 * i: str((i + 1) % 1000) for i in range(1000)}


def base_measures(t):
    w = WORD.findall(t or "")
    windows = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
    seen, covered = Counter(windows), set()
    for k, x in enumerate(windows):
        if seen[x] > 1:
            covered.update(range(k, k + 8))
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_and_verdicts(spark, small_docs, make_docs):
    phrase = "a b c d e f g h i j "
    edge = [*EDGE, phrase * 2, phrase + "x " + phrase + "y " + phrase, "dup line\nother\ndup line\n\n", "###a | <b> $$ %%"]
    for df in (small_docs, make_docs(edge)):
        texts = {r["doc_id"]: r["text"] for r in df.collect()}
        for r in quality.judge_quality(df).collect():
            want = base_measures(texts[r["doc_id"]])
            assert tuple(r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
            assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
            assert r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5)
    assert quality.judge_quality(make_docs([])).count() == 0


def test_rules_are_weighed_by_agreement():
    # Two rules that agree about the bad documents, and one that votes at random.
    patterns = []
    for truth, n in ((1, 900), (0, 100)):
        for noisy, share in ((1, 0.5), (0, 0.5)):
            patterns += [((truth, truth, noisy), int(n * share * 0.9)), ((truth, 1 - truth, noisy), int(n * share * 0.1))]
    prior, logs = quality.fit_votes(patterns)
    assert logs[0][0] < -2 and abs(logs[2][0]) < abs(logs[0][0]) / 3
    assert prior + logs[0][1] + logs[1][1] > 0 > prior + logs[0][0] + logs[1][0]
    assert quality.fit_votes([]) == (0.0, [])


def test_variety_votes_alike_at_every_length(make_docs):
    """Ten words in changing order: no window repeats, and neither a short nor a long text passes for good."""
    r = random.Random(4)

    def shuffled(n):
        return " ".join(" ".join(r.sample([f"word{k}" for k in range(10)], 10)) for _ in range(n // 10)) + "."
    rich = [" ".join(f"w{r.randrange(10**6)}" for _ in range(n)) + "." for n in (1500, 4000)]
    docs = make_docs([shuffled(n) for n in (20, 190, 400, 1500, 2000, 2500, 4000, 30000)] + rich + ["plain text of its own number %d, with some more words in it, quite ordinary ones." % k * 2 for k in range(200)])
    seen = {x["doc_id"]: x for x in quality.measures(docs).select("doc_id", "variety", *[c.alias("vote") for c in [quality.votes()["variety"]]]).collect()}
    assert all(seen[k]["vote"] == 0 and seen[k]["variety"] <= 0.5 for k in range(1, 8)) and seen[8]["vote"] == seen[9]["vote"] == 1
    assert all(0.05 <= seen[k]["variety"] < 0.053 for k in range(2, 8))  # ten words in each stretch, one of them once with a full stop
    judged = {x["doc_id"]: x["quality"] for x in quality.judge_quality(docs).collect()}
    assert max(judged[k] for k in range(2, 8)) - min(judged[k] for k in range(2, 8)) < 0.2


@pytest.mark.parametrize(("text", "postfix"), [
    ("MIT", ["MIT"]), ("MIT OR Apache-2.0 AND BSD-3-Clause", ["MIT", "Apache-2.0", "BSD-3-Clause", "and", "or"]),
    ("(MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0", ["MIT", "Apache-2.0", "or", "GPL-2.0-only", "Classpath-exception-2.0", "with", "and"]),
    ("MIT and more words", ["MIT", "more", "and"])])
def test_expressions_become_postfix(text, postfix):
    assert [x[1] if isinstance(x, tuple) else x for x in licenses.parse_expression(text)] == postfix


@pytest.mark.parametrize("text", ["", "AND MIT", "(MIT", "MIT OR", "(MIT AND) X"])
def test_broken_expressions_are_refused(text):
    with pytest.raises(ValueError):
        licenses.parse_expression(text)


def test_expression_freedom():
    value = lambda t: licenses.evaluate(licenses.parse_expression(t))
    assert value("MIT OR GPL-3.0") == ({"mit", "gpl"}, 1.0) and value("MIT AND GPL-3.0+") == ({"mit", "gpl"}, 0.4)
    assert value("GPL-2.0 WITH Classpath-exception-2.0") == ({"gpl"}, 0.4) and value("LGPL-2.1-only")[0] == {"lgpl"}


@pytest.mark.parametrize(("text", "labels", "score"), [
    ("SPDX-License-Identifier: MIT\nAll rights reserved. GNU Affero General Public License", {"agpl", "mit", "reserved"}, 0.0),
    ("SPDX-License-Identifier: MIT OR AGPL-3.0", {"agpl", "mit"}, 1.0), ("All rights reserved.", {"reserved"}, 0.0), ("MIT license", {"mit"}, 1.0),
    ("SPDX-License-Identifier: Apache-2.0 and the GNU General Public License", {"apache", "gpl"}, 0.4), ("no notice", set(), 1.0)])
def test_the_strictest_licence_gives_the_score(text, labels, score):
    found = licenses.scan_text(text)
    assert labels <= set(filter(None, found[5].split(","))) and found[6] == score


def base_licences(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    at = [(k, label) for p, label in licenses.BASE.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
    return len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_licence_scans(spark, small_docs, make_docs):
    edge = [*EDGE, "The MIT License. MIT LICENSE", "CC-BY 4.0; cc by cc by", "GNU General\nPublic License/apache license", "submit license",
            "// SPDX-License-Identifier: MIT OR GPL-2.0-only */", "SPDX-License-Identifier: (MIT"]
    for df in (small_docs, make_docs(edge)):
        texts = {r["doc_id"]: r["text"] for r in df.collect()}
        for r in licenses.scan_licenses(df).collect():
            assert tuple(r[k] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == base_licences(texts[r["doc_id"]])
            assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    got = {r["doc_id"]: r for r in licenses.scan_licenses(make_docs(edge)).collect()}
    assert got[14]["labels"] == "gpl,mit" and got[14]["expressions"] == ["MIT OR GPL-2.0-only */"] and got[15]["labels"] == ""
    assert licenses.scan_licenses(make_docs([])).count() == 0


def test_byte_bpe_equals_tiktoken_and_round_trips(spark, small_docs, make_docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = bpe.load_ranks(f.read())
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    edge = [*EDGE, "<|endoftext|> it's we'll 12³ ½", "a b c\x1cd \n\n  e", "ab" * 3000, "\U0001f600 Ａſſ"]
    for df in (small_docs, make_docs(edge)):
        texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
        encoded = bpe.encode_documents(df, path, public_tokenizers.PATTERN, with_ids=True).persist()
        for r in encoded.collect():
            ids = known.encode_ordinary(texts[r["doc_id"]])
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
            assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        back = {r["doc_id"]: r["text"] for r in bpe.decode_documents(encoded, path, public_tokenizers.PATTERN).collect()}
        encoded.unpersist()
        assert back == texts
    assert bpe.encode_documents(make_docs([]), path, public_tokenizers.PATTERN).count() == 0
