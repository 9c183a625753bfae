"""Every registered query of the registers against its SQL in DuckDB."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from terraloom.plans import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    out = []
    for r in df.astype(object).itertuples(index=False):
        out.append(tuple(None if v is None or pd.isna(v) else (float(v) if isinstance(v, float) else v.item() if hasattr(v, "item") else v) for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, db, name):
    assert name in catalog.ORACLES
    ours = catalog.QUERIES[name](spark, SF_DIR).toPandas()
    theirs = db.execute(catalog.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    a, b = rows(ours), rows(theirs)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert len(x) == len(y)
        for u, v in zip(x, y, strict=True):
            assert (u == v) or (isinstance(u, float) and isinstance(v, float) and abs(u - v) < 1e-6 * max(1, abs(u))) or (isinstance(u, (int, float)) and isinstance(v, (int, float)) and float(u) == float(v)), (x, y)
