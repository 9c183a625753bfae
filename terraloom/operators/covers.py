"""Covers of polygons by cells of several sizes, and joins of layers by them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.functions import geometry as G
from terraloom.functions.shapes import Shape, shapes_of
from terraloom.operators import repair
from terraloom.operators.spatial import tile_size
from terraloom.session import checkpointed, spread, unused

#: Sizes of cells: the smallest, and this many doublings.
LEVELS = 16
#: Bits of a cell's column in its key.
BITS = 24


def _key(level: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A cell as one whole number; its parent is at half its place, a level up."""
    return (np.int64(level) << 2 * BITS + 4) | ((x & ((1 << BITS) - 1)) << BITS) | (y & ((1 << BITS) - 1))


def _along(s: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, column, row) of the cells that segments go through, with a little more at their corners."""
    low, high = np.minimum(s[:, 1], s[:, 3]), np.maximum(s[:, 1], s[:, 3])
    first, last = np.floor(low / size - 1e-9).astype(np.int64), np.floor(high / size + 1e-9).astype(np.int64)
    k, place = repair._spread(last - first + 1)
    row = first[k] + place
    rise = s[k, 3] - s[k, 1]
    level = rise == 0
    ends = [s[k, 0] + (np.clip(edge * size, low[k], high[k]) - s[k, 1]) * (s[k, 2] - s[k, 0]) / np.where(level, 1, rise) for edge in (row, row + 1)]
    left, right = np.where(level, np.minimum(s[k, 0], s[k, 2]), np.minimum(*ends)), np.where(level, np.maximum(s[k, 0], s[k, 2]), np.maximum(*ends))
    begin, end = np.floor(left / size - 1e-9).astype(np.int64), np.floor(right / size + 1e-9).astype(np.int64)
    r, place = repair._spread(end - begin + 1)
    return k[r], begin[r] + place, row[r]


def _walked(s: np.ndarray, size: float) -> np.ndarray:
    """(column, row) of the cells that segments go through; each once."""
    return np.unique(np.stack(_along(s, size)[1:], 1), axis=0)


def _inside(s: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Even-odd, of points that lie on few different heights: the edges' places on each height are sorted once."""
    heights, at = np.unique(y, return_inverse=True)
    first, last = np.searchsorted(heights, np.minimum(s[:, 1], s[:, 3]), "left"), np.searchsorted(heights, np.maximum(s[:, 1], s[:, 3]), "left")
    k, place = repair._spread(last - first)
    h = first[k] + place
    cross = s[k, 0] + (heights[h] - s[k, 1]) * (s[k, 2] - s[k, 0]) / (s[k, 3] - s[k, 1])
    rank = np.lexsort((np.concatenate([cross, x]), np.concatenate([h, at])))
    edge = np.concatenate([np.ones(len(cross), np.int64), np.zeros(len(x), np.int64)])[rank]
    before = np.empty(len(rank), np.int64)
    before[rank] = np.cumsum(edge)
    start = np.searchsorted(np.sort(h), at, "left")
    return (before[len(cross) :] - start) % 2 == 1


def cover(shape: Shape, size: float, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """(cells, ancestors) of a shape, as keys: the smallest cells that its edges go through, and inside them cells as large as
    fit between; and all larger cells around these. Both are bounded by the outline's length in smallest cells, not by the
    area. An empty shape has none."""
    s = repair._segments(shape)
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = s.reshape(-1, 2).min(0), s.reshape(-1, 2).max(0)
    # No cell inside a shape is larger than the shape: larger ones are but ancestors.
    inner = min(levels, max(0, int(np.ceil(np.log2(max(float((high - low).max()) / size, 1))))))
    border = [_walked(s, size)]
    while len(border) <= inner:
        border.append(np.unique(border[-1] >> 1, axis=0))
    cells = [_key(0, *border[0].T)]
    top = size * 2**inner
    (x0, y0), (x1, y1) = np.floor(low / top).astype(np.int64), np.floor(high / top).astype(np.int64)
    open_ = np.stack(np.meshgrid(np.arange(x0, x1 + 1), np.arange(y0, y1 + 1)), -1).reshape(-1, 2)
    for level in range(inner, -1, -1):
        known = _key(level, *border[level].T)
        through = np.isin(_key(level, *open_.T), known)
        rest = open_[~through]
        side = size * 2**level
        within = _inside(s, (rest[:, 0] + 0.5) * side, (rest[:, 1] + 0.5) * side) if len(rest) else np.zeros(0, bool)
        cells.append(_key(level, *rest[within].T))
        child = open_[through] * 2
        open_ = np.concatenate([child + (i, j) for i in (0, 1) for j in (0, 1)])
    own = np.unique(np.concatenate(cells))
    ups, around = [np.zeros(0, np.int64)], np.zeros((0, 2), np.int64)
    for level in range(inner + 1):
        here = own[own >> 2 * BITS + 4 == level]
        place = np.stack([here >> BITS, here], 1) & ((1 << BITS) - 1)
        place = np.where(place >= 1 << BITS - 1, place - (1 << BITS), place)
        around = np.unique(np.concatenate([place, around]) >> 1, axis=0)
        if level < levels:
            ups.append(_key(level + 1, *around.T))
    larger = {(int(x), int(y)) for x, y in around}
    for level in range(inner + 2, levels + 1):
        larger = {(x >> 1, y >> 1) for x, y in larger}
        ups.append(_key(level, *np.array(sorted(larger)).T))
    return own, np.unique(np.concatenate(ups))


def _small_covers(segments: list[np.ndarray], size: float, levels: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """`cover` of shapes that are no larger than a smallest cell, all at once: their edges go through all cells they have."""
    owner = np.repeat(np.arange(len(segments)), [len(s) for s in segments])
    k, x, y = _along(np.concatenate(segments), size)

    def dealt(owners: list, keys: list) -> list[np.ndarray]:
        both = np.unique(np.stack([np.concatenate(owners), np.concatenate(keys)], 1), axis=0) if owners else np.zeros((0, 2), np.int64)
        return np.split(both[:, 1], np.searchsorted(both[:, 0], np.arange(1, len(segments))))

    own = dealt([owner[k]], [_key(0, x, y)])
    ups = dealt([owner[k]] * levels, [_key(n, x >> n, y >> n) for n in range(1, levels + 1)])
    return list(zip(own, ups, strict=True))


def all_covers(shapes: list[Shape], size: float, levels: int = LEVELS) -> list[tuple[np.ndarray, np.ndarray]]:
    """`cover` of each shape; those no larger than a smallest cell are done together."""
    segments = [repair._segments(g) for g in shapes]
    extent = [float(np.ptp(s.reshape(-1, 2), axis=0).max()) if len(s) else np.inf for s in segments]
    small = [i for i, e in enumerate(extent) if e <= size]
    out = [None if e <= size else cover(g, size, levels) for e, g in zip(extent, shapes, strict=True)]
    for i, c in zip(small, _small_covers([segments[i] for i in small], size, levels) if small else [], strict=True):
        out[i] = c
    return out


def covered(df: DataFrame, size: float, levels: int = LEVELS, geometry: str = "geometry") -> DataFrame:
    """`df` with `cells` and `ancestors` (arrays of keys) of each geometry's cover; null and empty ones have none. Places must be
    within 2^23 smallest cells of the origin."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = all_covers([g or [] for g in shapes_of(batch.column(geometry))], size, levels)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([f[i] for f in found], pa.list_(pa.int64())) for i in range(2))], names=[*names, "cells", "ancestors"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{schema}, cells array<long>, ancestors array<long>")


def candidate_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, size: float, levels: int = LEVELS) -> DataFrame:
    """(left id, right id) of features whose covers meet, each pair once: a cell of one is a cell of the other, or lies in one.
    Equal cells are found as equal keys, and contained ones as keys of the ancestors, so both are equi-joins. The planner's estimate
    of size is of rows before their cells are exploded, so by itself it would broadcast whole layers through the driver."""
    a, b = (checkpointed(covered(spread(df.select(i, "geometry"), i), size, levels).drop("geometry")) for df, i in ((left, left_id), (right, right_id)))
    rows = lambda df, i, c: df.select(i, F.explode(c).alias("cell"))
    level = lambda c: F.shiftright(c, 2 * BITS + 4)
    # Ancestors of a level of which the other layer has no cell meet nothing.
    levels_of = lambda df: [r[0] for r in df.select(F.explode(F.array_distinct(F.transform("cells", level))).alias("level")).distinct().collect()]

    def met(df: DataFrame):
        known = levels_of(df)
        return F.filter("ancestors", lambda c: level(c).isin(known))

    same = rows(a, left_id, F.col("cells")).join(rows(b, right_id, F.concat("cells", met(a))).hint("merge"), "cell").select(left_id, right_id)
    larger = rows(a, left_id, met(b)).join(rows(b, right_id, F.col("cells")).hint("merge"), "cell").select(left_id, right_id)
    return same.unionByName(larger).distinct()


def cover_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, size: float | None = None, levels: int = LEVELS) -> DataFrame:
    """(left id, right id, common): pairs of features that share ground, with its area, as `spatial.overlap_join`; but a feature
    has as many rows as its outline needs, not as its box. Ids are unique and have different names. Without a `size` it is
    that of the right layer's features on average."""
    size = size or tile_size(right)
    pairs = candidate_pairs(left, right, left_id, right_id, size, levels)
    a, b = unused(left, "a"), unused(right, "b")
    # A feature that meets many comes with all of its pairs in one task of a join; the overlay of pairs is dealt out again.
    # Geometries count as one element long in the planner's estimate, so here too it is told not to broadcast.
    both = pairs.join(left.select(left_id, F.col("geometry").alias(a)).hint("merge"), left_id).join(right.select(right_id, F.col("geometry").alias(b)).hint("merge"), right_id)
    measured = spread(both, left_id, right_id).select(left_id, right_id, repair.intersection(F.col(a), F.col(b)).alias("both"))
    return measured.select(left_id, right_id, G.area(F.col("both")).alias("common")).where("common > 0")
