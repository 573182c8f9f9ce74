"""Every query against its DuckDB text on the smallest tables."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return None if math.isnan(value) else f"{float(value):.9g}"
    return None if value is None else str(value)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    duck.execute(entry.oracle_sql()[name])
    theirs_columns = [d[0] for d in duck.description]
    assert sorted(theirs_columns) == columns
    places = [theirs_columns.index(c) for c in columns]
    theirs = sorted(str([plain(r[i]) for i in places]) for r in duck.fetchall())
    assert ours == theirs
    assert ours


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "tag_name"
