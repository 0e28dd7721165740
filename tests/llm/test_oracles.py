import duckdb
import pytest

from opslog.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_oracle(spark, name):
    folder = "/root/testdata/sf0.001"
    database = duckdb.connect()
    for table in ("documents", "embeddings"):
        database.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = database.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, folder).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall()) != []
