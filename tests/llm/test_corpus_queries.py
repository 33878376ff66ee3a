"""Each corpus query against its SQL in DuckDB, where it has one."""

import glob

import duckdb
import pytest

from lectern.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {path.rsplit('/', 1)[1].removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    want = con.execute(SQL[name]).df()
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and len(got)
    rows = lambda df: sorted(tuple(map(str, r)) for r in df[sorted(df.columns)].itertuples(index=False))
    assert rows(got) == rows(want)
