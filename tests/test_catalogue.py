"""Every query with SQL gives DuckDB's rows on the smallest tables; the others give rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from quern.plans.catalogue import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in SQL:
        assert len(got)
        return
    want = duck.sql(SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = lambda rows: sorted(rows, key=repr)
    clean = lambda df: order([tuple(float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in row) for row in df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False)])
    assert clean(got) == clean(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
