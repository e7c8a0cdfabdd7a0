"""Every registered query with an oracle equals its DuckDB SQL on sf0.001 (the driver checks sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_compare import _rows
from trendlake.sources.tables import TABLES

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_registered_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert {"rf_deaths", "gbt_deaths"} <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sp = E.queries()[key](spark, SF_SMALL).toPandas()
    dk = con.execute(E.oracle_sql()[key]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk)
    assert _rows(sp) == _rows(dk)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["location", "model_version", "n", "rmse", "mae", "r2", "target"]
