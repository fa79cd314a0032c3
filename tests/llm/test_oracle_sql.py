"""Registered queries against their SQL, and what they are registered under."""

import duckdb
import pytest

import __spark_entry__ as entry
from rosterforge.llm.catalog import REGISTRY
from tests.conftest import SF
from tools.check_oracle import TABLES, rows_of


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = REGISTRY[name].run(spark, SF)
    result = con.execute(REGISTRY[name].sql)
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_registered():
    known = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} == {name.split("_")[0] for name in known if name in REGISTRY}
    assert "pipeline" in known
