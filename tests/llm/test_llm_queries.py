import glob
import os

import duckdb
import pytest

from loomspark.llm import queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": [("doc_id", "bigint"), ("section", "int")],
    "p2_found": [("key", "string")],
    "p3_found": [("id", "string"), ("doc_id", "bigint")],
    "p4_found": [("id_a", "string"), ("id_b", "string")],
    "p5_found": [("outcome_id", "bigint"), ("field", "string"), ("defect", "string")],
    "p6_found": [("doc_id", "bigint"), ("item_id", "bigint")],
    "p8_found": [("doc_id", "bigint")],
}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_distinct_rows(spark, name):
    found = queries.QUERIES[name](spark, FOLDER)
    assert found.dtypes == COLUMNS[name]
    rows = found.collect()
    assert len(rows) == len(set(rows))
    if name == "p4_found":
        assert all(r.id_a < r.id_b for r in rows)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    wanted = {tuple(r) for r in connection.sql(queries.SQL[name]).fetchall()}
    assert {tuple(r) for r in queries.QUERIES[name](spark, FOLDER).collect()} == wanted
