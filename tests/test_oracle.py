"""Every registered query against its DuckDB oracle SQL on the smallest
driver tables (scripts/oracle_check.py runs the same check at any scale)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from rillet.plans.fixtures import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float) and math.isnan(v):
        return ("~nan",)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


ALL = sorted(E.oracle_sql())


@pytest.mark.parametrize("name", ALL)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, cur.fetchall())


def test_chunked_indicators_match_oracle(spark, con):
    """The skew-safe path (rows cut into chunks with copied context) against
    the plain SQL windows, with chunks far smaller than a symbol's series."""
    from rillet.plans import fixtures as fx
    from rillet.plans.indicators import flow_indicators
    df = flow_indicators(fx.bars(spark, SF), chunk_rows=97)
    cur = con.execute(E.oracle_sql()["flow_indicators"])
    dcols = [d[0] for d in cur.description]
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, cur.fetchall())


# Every label that a rule names, and the query and column in which it must occur.
ARMS = {
    ("weather_type", "weather_type"): {"rainy", "hot", "cold", "moderate"},
    ("popularity", "popularity"): {"viral", "popular", "moderate", "new"},
    ("regex_flag", "is_external"): {True, False},
    ("legendary_tier", "legendary_tier"): {"mythical", "box_legendary", "sub_legendary", None},
    ("sentiment", "market_sentiment"): {"bullish", "bearish", "neutral"},
    ("sentiment", "trend_7d"): {"up", "down"},
    ("quality_rating", "data_quality"): {"high", "medium", "low", "very_low"},
    ("manipulation_score", "volume_manipulation_flag"): {True, False},
    ("protocol_class", "protocol_family"): {"tcp", "udp", "icmp", "http", "other"},
    ("threat_level", "threat_level"): {"low", "medium", "high", "critical"},
    ("tri_state", "mission_outcome"): {"Success", "Failure", "Unknown"},
    ("complexity", "mission_complexity"): {"High", "Medium", "Low", "Unknown"},
}


def test_every_label_of_a_rule_occurs(spark):
    import __spark_entry__ as entry
    queries = entry.queries()
    for (key, column), labels in ARMS.items():
        found = {r[0] for r in queries[key](spark, "/root/testdata/sf0.01").select(column).distinct().collect()}
        assert labels <= found, (key, column, labels - found)
    ratings = {r[0] for r in queries["quality_rating"](spark, "/root/testdata/sf0.01").select("reliability_rating").distinct().collect()}
    assert "A" in ratings and "F" in ratings


# Keys whose rows need no statistic: building them reads schemas and nothing else.
ROW_WISE = {"packet_category": 1, "onehot_decode": 1, "isin_flag": 1, "pattern_flag": 1, "pct_change_row": 1, "day_type": 1, "round_cols": 1,
            "select_reorder": 1, "protocol_class": 1, "flow_posts": 1, "flow_weather": 1, "flow_retail_cross": 3, "flow_quality_branch": 5,
            "flow_cross_validation": 5, "flow_legendary": 2}


@pytest.mark.parametrize("key", sorted(ROW_WISE))
def test_building_runs_no_job_beyond_schema_reads(spark, key):
    import __spark_entry__ as entry
    sc = spark.sparkContext
    group = f"building-{key}"
    sc.setJobGroup(group, group)
    try:
        entry.queries()[key](spark, SF)
        assert len(sc.statusTracker().getJobIdsForGroup(group)) <= ROW_WISE[key]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
