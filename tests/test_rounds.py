"""Loops that join a table with itself plan each round in the same time."""

import time

from pyspark.sql import functions as F

from terraloom.operators import spatial


def test_a_ring_of_many_edges_takes_few_quick_rounds(spark):
    n = 1 << 18
    ring = spark.range(n).select("id", ((F.col("id") + 1) % n).alias("next"))
    begin = time.monotonic()
    got = spatial._ranked_rings(ring).agg(F.count("*"), F.max("ring"), F.max("steps"), F.sum("steps")).head()
    assert tuple(got) == (n, 0, n - 1, n * (n - 1) // 2)
    assert time.monotonic() - begin < 240
