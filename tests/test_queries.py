"""Every core query against its SQL on the small tables, and those without SQL for a stable schema."""

import glob
import os

import duckdb
import pytest

from loomspark.plans import registry

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return connection


def rows(frame, columns):
    return sorted(map(str, frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist()))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, FOLDER).toPandas()
    if name in SQL:
        wanted = duck.sql(SQL[name]).df()
        assert sorted(found.columns) == sorted(wanted.columns)
        columns = sorted(found.columns)
        assert rows(found, columns) == rows(wanted, columns)
