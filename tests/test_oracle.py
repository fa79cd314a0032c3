"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from rosterforge.catalog import REGISTRY
from tests.conftest import SF
from tools.check_oracle import TABLES, rows_of

# queries whose rule is the caller's function, matching blocks or vectors
PYTHON = {"q_place_gate", "q_name_similarity", "q_image_rank", "q_apply_model"}
# the training-data operators have tests of their own
QUERIES = {name: run for name, run in entry.queries().items() if name in REGISTRY}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for t in TABLES:
        made.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return made


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert name in PYTHON or not ("Python" in plan or "InPandas" in plan)
    mine = rows_of(df.columns, df.collect())
    assert len(set(df.columns)) == len(df.columns)
    if name in SQL:
        result = con.execute(SQL[name])
        columns = [d[0] for d in result.description]
        assert sorted(df.columns) == sorted(columns)
        assert mine == rows_of(columns, result.fetchall())
    else:
        assert mine


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)
