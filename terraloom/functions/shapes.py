"""Geometries in the steps that need Python: Arrow's buffers as numpy arrays, without pandas and without a value a point.

Batches of only null or only empty geometries are as safe as any other: nothing nested is ever turned into Python objects.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from terraloom.functions import geometry as G

#: In Python: polygons, each a list of rings, each an array of (x, y) rows.
Shape = list

TYPE = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def shapes_of(column: pa.Array) -> list[Shape | None]:
    """A column's geometries; None for null. Null polygons and rings are empty, null coordinates not a number."""
    if isinstance(column, pa.ChunkedArray):
        return [s for chunk in column.chunks for s in shapes_of(chunk)]
    if not len(column):
        return []
    # A slice's values are those of the whole array: only the stretch that the slice has is taken up.
    stretch = lambda a: a.values.slice(a.offsets[0].as_py(), a.offsets[len(a)].as_py() - a.offsets[0].as_py())
    polygons = stretch(column)
    rings = stretch(polygons) if len(polygons) else polygons.values.slice(0, 0)
    points = stretch(rings) if len(rings) else rings.values.slice(0, 0)
    first, second, third = (np.asarray(a.offsets) - a.offsets[0].as_py() if len(a) else np.zeros(1, np.int64) for a in (column, polygons, rings))
    xy = np.stack([points.field(i).to_numpy(zero_copy_only=False) for i in range(2)], 1)
    null = np.asarray(column.is_null())

    def polygon(p: int) -> list[np.ndarray]:
        return [xy[third[r] : third[r + 1]] for r in range(second[p], second[p + 1])]

    return [None if null[i] else [polygon(p) for p in range(first[i], first[i + 1])] for i in range(len(column))]


def column_of(shapes: list[Shape | None]) -> pa.Array:
    there = [s if s is not None else [] for s in shapes]
    rings = [np.asarray(r, float).reshape(-1, 2) for s in there for p in s for r in p]
    xy = np.concatenate([np.zeros((0, 2)), *rings])
    ends = lambda sizes: pa.array(np.cumsum([0, *sizes]), pa.int32())
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], fields=[pa.field("x", pa.float64()), pa.field("y", pa.float64())])
    of_rings = pa.ListArray.from_arrays(ends(map(len, rings)), points)
    of_polygons = pa.ListArray.from_arrays(ends(len(p) for s in there for p in s), of_rings)
    return pa.ListArray.from_arrays(ends(map(len, there)), of_polygons, mask=pa.array([s is None for s in shapes], pa.bool_()))


def by_row(work: Callable[..., Shape | None], *geometries: Column) -> Column:
    """`work` of each row's geometries, in Arrow batches; null if one of them is null. Not deterministic by name, so that
    the optimizer leaves it in a projection of its own."""

    def run(*columns: pa.Array) -> pa.Array:
        return column_of([None if any(s is None for s in row) else work(*row) for row in zip(*map(shapes_of, columns), strict=True)])

    return F.arrow_udf(_typed(run, len(geometries)), G.GEOMETRY).asNondeterministic()(*geometries)


def by_batch(work: Callable[..., list[Shape | None]], *geometries: Column) -> Column:
    """As `by_row`, with `work` of the geometries of many rows at once: a list an argument, without rows that have a null."""

    def run(*columns: pa.Array) -> pa.Array:
        rows = list(zip(*map(shapes_of, columns), strict=True))
        whole = [i for i, row in enumerate(rows) if all(s is not None for s in row)]
        out: list[Shape | None] = [None] * len(rows)
        if whole:
            for i, s in zip(whole, work(*(list(c) for c in zip(*(rows[i] for i in whole), strict=True))), strict=True):
                out[i] = s
        return column_of(out)

    return F.arrow_udf(_typed(run, len(geometries)), G.GEOMETRY).asNondeterministic()(*geometries)


def holds_by_batch(work: Callable[[list[Shape]], list[bool]], geometry: Column) -> Column:
    def run(column: pa.Array) -> pa.Array:
        shapes = shapes_of(column)
        held = iter(work([s for s in shapes if s is not None]))
        return pa.array([None if s is None else bool(next(held)) for s in shapes], pa.bool_())

    return F.arrow_udf(run, "boolean").asNondeterministic()(geometry)


def holds_by_row(work: Callable[[Shape], bool], geometry: Column) -> Column:
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if s is None else bool(work(s)) for s in shapes_of(column)], pa.bool_())

    return F.arrow_udf(run, "boolean").asNondeterministic()(geometry)


def _typed(run: Callable, n: int) -> Callable:
    """`run` with n named arguments, which Spark reads the kind of function from."""
    if n == 1:
        return lambda a: run(a)
    return lambda a, b: run(a, b)
