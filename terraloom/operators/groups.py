"""Python work on many small groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows of small groups that are worked on together.
TOGETHER = 2000


def each_group(df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """`work` of the rows of each key, as with applyInArrow, but the groups of a partition come in one sorted stream: a group
    costs no exchange of its own with the Python worker, which matters where groups are many and small. A task holds one group at
    a time. Null keys are groups like any other. Partitions are as many as spark.sql.shuffle.partitions says, and are not joined by
    their bytes, as the work is large for its bytes."""
    return whole_groups(df, keys, lambda rows, _: work(rows), schema, 1)


def whole_groups(df: DataFrame, keys: list[str], work: Callable[[pa.Table, list[int]], pa.Table], schema: str, least: int = TOGETHER) -> DataFrame:
    """As `each_group`, with `work` of the rows of several groups, and of the places where these begin: whole groups with `least`
    rows or more in all, so that small ones cost no call of their own. A task holds these, or one group that is larger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        begins: list[int] = []
        total, now = 0, None
        for batch in batches:
            names = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            start = 0
            for i, name in enumerate(names):
                if begins and name == now:
                    continue
                if begins and total + i - start >= least:
                    yield from work(pa.Table.from_batches([*held, batch.slice(start, i - start)]).combine_chunks(), begins).to_batches()
                    held, begins, total, start = [], [], 0, i
                begins.append(total + i - start)
                now = name
            if start < len(names):
                held.append(batch.slice(start))
                total += len(names) - start
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks(), begins).to_batches()

    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
