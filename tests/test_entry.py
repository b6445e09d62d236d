
import duckdb
import pytest

import __spark_entry__ as E
from transitflow.plans import catalog, oracle
from conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["trip_id", "stop_id", "sequence", "dist"]
    assert df.count() == 891


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(catalog.queries()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = df.collect()
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    orows = res.fetchall()
    idx = {c: i for i, c in enumerate(ocols)}
    a = sorted((tuple(_norm(r[c]) for c in sorted(df.columns)) for r in rows), key=repr)
    b = sorted((tuple(_norm(r[idx[c]]) for c in sorted(ocols)) for r in orows), key=repr)
    assert a == b


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_plan_has_no_cross_join_or_python(spark, name, capsys):
    df = E.queries()[name](spark, SF001)
    capsys.readouterr()
    df.explain("extended")
    plan = capsys.readouterr().out
    assert not [w for w in FORBIDDEN if w in plan], name
