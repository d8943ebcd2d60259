"""Tables whose vector ids have gaps: events without a vector are not rows of
txn_ml, and what is fitted on it does not see them."""

import duckdb
import pytest

from tools.oracle_check import digest
from txnlens.plans.catalog import load_all

from .conftest import SF001


@pytest.mark.parametrize("name", ["engineered_features"])
def test_queries_with_missing_vectors(spark, tmp_root, name):
    spark.read.parquet(f"{SF001}/events.parquet").write.parquet(f"{tmp_root}/events.parquet")
    spark.read.parquet(f"{SF001}/embeddings.parquet").where("vec_id % 7 <> 3").write.parquet(f"{tmp_root}/embeddings.parquet")
    con = duckdb.connect()
    for t in ("events", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_root}/{t}.parquet/*.parquet')")
    q = load_all()[name]
    df = q.fn(spark, tmp_root)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(q.sql)
    cols = [d[0] for d in res.description]
    assert 0 < len(rows) < 1000 and digest(df.columns, rows)[0] == digest(cols, res.fetchall())[0]
