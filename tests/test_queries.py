"""Every query with SQL gives the same rows as DuckDB."""

import duckdb
import pytest

from millrace.plans import more_queries  # noqa: F401  registers its queries
from millrace.plans.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    got = QUERIES[name](spark, SMALL)
    if name not in ORACLES:
        assert got.count() > 0
        return
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    order = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=order) == sorted(want.fetchall(), key=order)
