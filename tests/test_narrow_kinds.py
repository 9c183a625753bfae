"""Readers of responses that look up only the fields they need give the same rows."""

import pytest

from terraloom.plans import livestock_queries as L
from terraloom.sources import register_responses as R

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("narrow", "read"), [(R.PRACTICES, R.practices), (R.DECLARATIONS, R.declarations), (R.HERD_ROWS, R.herd_rows), (R.PEOPLE, lambda h: R.persons(h, "Bruger", "user"))])
def test_narrow_herds_are_the_same(spark, narrow, read):
    path = L.landed(spark, L._herds(spark, SF_DIR).select("herd.*"))
    whole, few = (read(R.herd_masters(R.responses(spark, path, kind))) for kind in (R.HERD, narrow))
    assert len(R.responses(spark, path, narrow).columns) < len(R.responses(spark, path, R.HERD).columns)
    assert few.columns == whole.columns and few.count() == whole.count() > 0
    assert few.exceptAll(whole).isEmpty()


def test_files_of_arrivals_are_as_many_as_partitions(spark, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert L._arrivals(spark, SF_DIR, R.PRACTICES).select("page").distinct().count() == 9
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
