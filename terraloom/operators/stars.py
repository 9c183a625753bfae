"""The greedy star dissolve: features in order of their ids, each taking its free neighbours."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.operators.dedupe import numbered
from terraloom.operators.groups import each_group
from terraloom.session import checkpointed, settled

#: Features of a range of ids at most, about.
RANGE_ROWS = 100_000


def greedy_stars(features: DataFrame, links: DataFrame, id_col: str = "id", number: str = "group_id") -> DataFrame:
    """(id, centre, number): features are gone through by their ids; one that is free becomes a centre and takes its neighbours
    that are free. Centres are numbered from 1 in order.

    So a feature is a centre unless a smaller neighbour is one, and belongs to the smallest of these. Ids are dealt to
    ranges; a task decides a range in order, as far as what it needs of smaller ranges is known, and what is decided is
    joined in for the next round. There are at most as many rounds as ranges; where no chain of neighbours with rising
    ids spans many ranges there are few. `links` (src, dst) has each pair of neighbours, in any direction and as often
    as it likes; pairs with ids that `features` hasn't are left out. Ids are whole numbers; null ones
    have no row, repeated ones one.
    """
    spark = features.sparkSession
    nodes = features.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL").distinct()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-nodes.count() // RANGE_ROWS))
    # Dealt by bounds that are quantiles, so that ranges hold about as many features each.
    bounds = nodes.select(F.percentile_approx("id", [i / ranges for i in range(1, ranges)], 10_000)).head()[0] or [] if ranges > 1 else []
    cut = F.array(*map(F.lit, sorted(set(bounds)))) if bounds else F.array().cast("array<long>")
    nodes = checkpointed(nodes.withColumn("range", F.size(F.filter(cut, lambda b: b <= F.col("id")))))
    pairs = links.select(F.least("src", "dst").cast("long").alias("small"), F.greatest("src", "dst").cast("long").alias("id")).where("small < id").distinct()
    known = nodes.select(F.col("id").alias("small"), F.col("range").alias("below"))
    pairs = checkpointed(pairs.join(nodes, "id").join(known, "small").select("id", "range", "small", (F.col("below") == F.col("range")).alias("near")))

    def decide(rows: pa.Table) -> pa.Table:
        """Of a range: its features (small is null) and their smaller neighbours, with what is known of those in other ranges."""
        ids, small, said = (rows[c].to_pylist() for c in ("id", "small", "said"))
        below: dict[int, list] = {}
        for i, s, v in zip(ids, small, said, strict=True):
            below.setdefault(i, [])
            if s is not None:
                below[i].append((s, v))
        state: dict[int, int | None] = {}
        for i in sorted(below):
            seen = [state.get(s, v) if v is None else v for s, v in below[i]]
            state[i] = 0 if 1 in seen else None if None in seen else 1
        return pa.table({"id": pa.array(list(state), pa.int64()), "range": pa.array(np.full(len(state), rows["range"][0].as_py()), pa.int32()), "state": pa.array(list(state.values()), pa.int32())})

    state = nodes.withColumn("state", F.lit(None).cast("int"))
    while True:
        found = state.select(F.col("id").alias("small"), F.col("state").alias("said"))
        far = pairs.where("NOT near").join(found, "small").select("id", "range", "small", "said")
        rows = nodes.select("id", "range", F.lit(None).cast("long").alias("small"), F.lit(None).cast("int").alias("said"))
        rows = rows.unionByName(pairs.where("near").select("id", "range", "small", F.lit(None).cast("int").alias("said"))).unionByName(far)
        state = settled(each_group(rows, ["range"], decide, "id long, range int, state int"))
        if state.where("state IS NULL").isEmpty():
            break
    centres = state.where("state = 1").select(F.col("id").alias("small"))
    taken = pairs.join(centres, "small").join(state.where("state = 0").select("id"), "id").groupBy("id").agg(F.min("small").alias("centre"))
    stars = checkpointed(taken.unionByName(centres.select(F.col("small").alias("id"), F.col("small").alias("centre"))))
    names = numbered(checkpointed(centres.select(F.col("small").alias("centre"))), ["centre"], number)
    return stars.join(names, "centre").select("id", "centre", number)
