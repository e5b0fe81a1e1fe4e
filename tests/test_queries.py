"""Every registered query against its SQL on the smallest data folder."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, rows_of
from pricetrail.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if QUERIES[n].sql is not None])
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    df = entry_module.queries()[name](spark, FOLDER)
    rel = con.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in rel.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, rel.fetchall())
