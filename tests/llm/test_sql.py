"""The training-data queries that SQL can express, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tests.test_queries import cells, left
from tidegrid.llm.queries import ORACLE_SQL, QUERIES
from tidegrid.sources import scratch

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    before = left(spark)
    with scratch.run(spark):
        df = QUERIES[name](spark, DATA)
        want = con.sql(ORACLE_SQL[name])
        columns = sorted(df.columns)
        assert columns == sorted(want.columns)
        assert cells(df.select(*columns).collect()) == cells(want.select(*columns).fetchall())
    assert left(spark) == before


@pytest.mark.parametrize("name", sorted({*QUERIES, "pipeline"} - {*ORACLE_SQL}))
def test_queries_without_sql_leave_nothing(spark, name):
    """They run as registered, and what they wrote for themselves is gone after the run."""
    before = left(spark)
    with scratch.run(spark):
        assert (corpus_pipeline.run if name == "pipeline" else QUERIES[name])(spark, DATA).count() > 0
    assert left(spark) == before
