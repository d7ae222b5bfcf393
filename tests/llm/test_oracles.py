import duckdb
import pytest

from millrace.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SMALL).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
