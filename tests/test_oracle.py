"""Every registered query with an oracle equals DuckDB at sf0.01 (the
driver's check: row count, column names, order-insensitive value hash)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

from .conftest import SF01

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF01}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["hour_bucket", "n_class0", "n_class1"] and df.count() == 24
