"""The queries that SQL can express against DuckDB."""

import glob
import os

import duckdb
import pytest

from terraloom.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    ours = queries.QUERIES[name](spark, SF_DIR)
    theirs = db.execute(queries.ORACLES[name])
    names = [d[0] for d in theirs.description]
    assert sorted(names) == sorted(ours.columns)
    assert sorted(map(tuple, ours.select(*names).collect()), key=str) == sorted(theirs.fetchall(), key=str)
