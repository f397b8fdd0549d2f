"""Driver contract and oracle agreement on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from scripts.check_oracle import digest
from terracat.plans.driver_tables import TABLES
from terracat.queries import QUERIES

from .conftest import SF_SMALL


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["geom_index_id", "data_type_id", "data_type_name", "geom_type_concept_id",
                          "geom_type_source_value", "database_schema", "table_name", "table_desc",
                          "data_source_id"]


def test_every_oracle_has_a_query():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 20
    assert set(QUERIES) <= set(o)      # every job outside the optional subpackage has an SQL oracle


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    fn, sql = QUERIES[name]
    df = fn(spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plans(spark, name):
    df = QUERIES[name][0](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PY_NODES), plan
