"""Every registered query against its SQL, on the smallest tables."""

import math
import re
from pathlib import Path

import duckdb
import pytest

from tidegrid.plans.queries import ORACLE_SQL, QUERIES
from tidegrid.sources import scratch

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test tables")


def cells(rows):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
            return f"{float(v):.6g}"
        return str(v)

    return sorted(tuple(map(cell, r)) for r in rows)


def left(spark):
    """What is in the shared folder."""
    folder = Path(scratch.root(spark).removeprefix("file://"))
    return sorted(p.name for p in folder.iterdir() if "-" in p.name and not re.fullmatch(r"[0-9a-f-]{36}", p.name)) if folder.is_dir() else []


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


def test_dimensions_are_broadcast(spark):
    plan = QUERIES["enrich_holidays"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
