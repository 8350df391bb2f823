import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Frame of documents from texts, or (id, text) or (id, text, lang) rows, with extra columns of clashing names."""
    def make(rows, lang="en"):
        full = []
        for i, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (i, r)
            full.append((r[0], r[1], r[2] if len(r) > 2 else lang, "s", len(r[1] or "")))
        df = spark.createDataFrame(full, SCHEMA)
        for c in ("n", "id", "key", "size", "shard", "slot", "score", "w", "line", "first", "component", "_bucket", "start", "length", "digest", "_toxic", "_dropped_lines", "_gone",
                  "row", "kept", "lines", "near", "rank", "range", "taken", "word", "runs", "a.b"):
            df = df.selectExpr("*", f"'clash' AS `{c}`")
        return df
    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
