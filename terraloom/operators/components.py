"""Connected components of an edge table, as rounds of DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.session import settled


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of `edges`; component is the smallest node that can be reached.

    Contraction: in a round every node takes its smallest neighbour (or itself) as parent, pointer jumps take it to the
    end of its chain of parents (their number is the logarithm of the longest chain), and the edges are rewritten to
    these ends, without loops and repeats. A round at least halves the nodes that still have edges; the minimum of a
    component never has a smaller neighbour, so it survives as the component's name. Each round is written to the
    shared folder.
    An edge with a null end is dropped. No edges: no rows.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    e = settled(e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    labels = e.select("u").union(e.select("v")).distinct().select(F.col("u").alias("node"), F.col("u").alias("component"))
    e = e.where("u <> v")
    while not e.isEmpty():
        both = e.union(e.select("v", "u"))
        parent = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("p"))
        while True:
            up = parent.select(F.col("k").alias("p"), F.col("p").alias("q"))
            jumped = settled(parent.join(up, "p").select("k", "p", "q"))
            parent = jumped.select("k", F.col("q").alias("p"))
            if jumped.where("p <> q").isEmpty():
                break
        labels = (
            labels.join(parent.withColumnRenamed("k", "component"), "component", "left")
            .select("node", F.coalesce("p", "component").alias("component"))
        )
        labels = settled(labels)
        e = (
            e.join(parent.select(F.col("k").alias("u"), F.col("p").alias("a")), "u")
            .join(parent.select(F.col("k").alias("v"), F.col("p").alias("b")), "v")
            .where("a <> b")
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
            .distinct()
        )
        e = settled(e)
    return labels
