"""Every registered query: runs at sf0.001, and equals its DuckDB oracle where one exists."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tidepool.plans import load_all

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
QUERIES = E.queries()
#: The training-data operators may use Python in tasks; none may join everything with everything.
CROSSED = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas")
LIBRARY = load_all()
SQL = E.oracle_sql()


def _canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con(smoke_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{smoke_dir}/{t}.parquet')")
    return c


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "median" in df.columns
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_oracle(spark, con, smoke_dir, name):
    df = QUERIES[name](spark, smoke_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Scan" in plan.replace("LocalTableScan", ""), "the plan reads no table"
    assert not [b for b in CROSSED + (PYTHON if name in LIBRARY else ()) if b in plan], "cross join or Python node in plan"
    srows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(srows) > 0
        return
    cur = con.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, drows)
