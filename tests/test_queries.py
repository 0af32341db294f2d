"""Every registered query against its check SQL at the smallest scale."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in CHECKS:
        assert found
        return
    result = con.execute(CHECKS[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in order) for r in result.fetchall()), key=repr)
    assert found == expected


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["page_id", "url"]
    assert df.count() > 0
