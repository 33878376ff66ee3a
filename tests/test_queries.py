"""Each registered query of the engine against its SQL in DuckDB, on the smallest tables."""

import functools
import glob
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import lectern.catalog_checks  # noqa: F401
from lectern import catalog_weekly
from lectern.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {path.rsplit('/', 1)[1].removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or value is not value or str(value) in ("NaT", "<NA>"):
        return "none"
    if isinstance(value, float) and not math.isinf(value):
        return f"{value:.5f}".replace("-0.00000", "0.00000")
    return str(value).removesuffix(" 00:00:00")


@pytest.fixture(scope="module", autouse=True)
def shared_run():
    """The weekly table is written once for all queries of this module."""
    patch = pytest.MonkeyPatch()
    patch.setattr(catalog_weekly, "Run", functools.cache(catalog_weekly.Run))
    yield
    patch.undo()


#: What is known of results that SQL can't give, on the smallest tables: columns, and a condition that every row meets.
INVARIANTS = {
    "ml_1": ("label", "label BETWEEN 0 AND 2 AND reader_id IS NOT NULL AND as_of_week_end IS NOT NULL"),
    "ml_2": ("label", "label BETWEEN 0 AND 2 AND reader_id IS NOT NULL AND as_of_week_end IS NOT NULL"),
    "ml_21": ("bar", "bar BETWEEN -1 AND 1 AND k = 3"),
    "src_10": ("n", "n > 0 AND channel IN ('web', 'app')"),
    "fe_16": ("method", "method IN ('pca', 'anchor', 'equal_weight', 'dropped') AND (method <> 'pca' OR failures = '')"),
    "fe_18": ("topic_breadth", "abs(topic_breadth) <= 5 AND topic_breadth_imputed_flag IN (0, 1) AND (topic_breadth_imputed_flag = 0 OR topic_breadth = 0)"),
    "fe_21": ("contribution", "contribution BETWEEN 0 AND 1 AND weight BETWEEN 0 AND 1"),
}


#: One of the queries that share their SQL.
DISTINCT = sorted({SQL.get(n, n): n for n in sorted(QUERIES, reverse=True)}.values())


@pytest.mark.parametrize("name", DISTINCT)
def test_query(spark, con, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    assert len(set(got.columns)) == len(got.columns)
    if name not in SQL:
        column, holds = INVARIANTS["fe_18" if name == "fe_19" else name]
        assert column in got.columns
        found = got.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr(holds)).alias("good")).first()
        assert found.n == found.good > 0
        return
    got, want = got.collect(), con.execute(SQL[name])
    names = [d[0] for d in want.description]
    want = want.fetchall()
    if got:
        assert sorted(got[0].__fields__) == sorted(names)
    order = sorted(names)
    rows = sorted(tuple(plain(r[c]) for c in order) for r in got)
    other = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in want)
    assert len(rows) == len(other)
    for a, b in zip(rows, other, strict=True):
        assert all(x == y or abs(float(x) - float(y)) < 2e-5 for x, y in zip(a, b, strict=True))
