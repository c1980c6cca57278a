"""A sample of registered queries against their DuckDB oracles at sf0.001
(the full set runs with tools/check_oracle.py at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tools.check_oracle import TABLES, rows_of

SAMPLE = ["segment_summary", "weekday_trend", "top_sellers", "dedup_comments", "burst_flags",
          "merged", "clean_text", "text_similarity", "association_rules", "hybrid_recommend",
          "ranking_metrics", "recommend_with_fallback"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, res.fetchall())
