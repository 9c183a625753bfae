"""Validity, repair, simplification and overlay of polygons, each feature or tile for itself.

The Python steps are marked as not deterministic, so that the optimizer leaves each in a projection of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import hypot

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.functions import crs
from terraloom.functions import geometry as G
from terraloom.functions.shapes import by_batch, column_of, holds_by_batch, shapes_of
from terraloom.functions.wkb import decode_one
from terraloom.operators.components import connected_components
from terraloom.operators.groups import whole_groups
from terraloom.session import checkpointed, unused

#: Coordinates are snapped to this grid before rings are cut and joined.
SNAP = 1e-3
#: Pairs of edges that are tried together, and edges in slabs that are ordered together.
PAIRS, SLABS = 1 << 19, 1 << 20
#: Geometries of at most so many edges are worked on together, and so many edges of them at once.
FEW, TOGETHER = 48, 1 << 14
#: The same for layers of many geometries, whose edges are tried in pairs: edges of a scene, and pairs of all that are together.
MANY, TRIED = 256, 1 << 18


def _segments(geometry) -> np.ndarray:
    parts = []
    for polygon in geometry:
        for ring in polygon:
            p = np.asarray(ring, float)
            if len(p) > 1:
                parts.append(np.concatenate([p[:-1], p[1:]], 1))
    return np.concatenate(parts) if parts else np.zeros((0, 4))


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For stretches of these sizes, end to end: (the stretch of each place, its place in the stretch)."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def near_pairs(s: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of segments (x1, y1, x2, y2) that go through one cell of a grid, about PAIRS at a time, some of them more than once.
    Segments that meet are among them. The grid's side is the segments' mean extent, so all together go through a few
    cells a segment, and a segment is in the cells along it, not in those of its box."""
    if len(s) < 2:
        return
    low, high = np.minimum(s[:, :2], s[:, 2:]), np.maximum(s[:, :2], s[:, 2:])
    origin = low.min(0)
    side = max(float((high - low).sum()) / (2 * len(s)), float((high.max(0) - origin).max()) / 2**20, 1e-12)
    first, last = np.floor((low[:, 1] - origin[1]) / side - 1e-6).astype(np.int64), np.floor((high[:, 1] - origin[1]) / side + 1e-6).astype(np.int64)
    k, place = _spread(last - first + 1)
    row = first[k] + place
    rise = s[k, 3] - s[k, 1]
    level = rise == 0
    x = []
    for edge in (row, row + 1):
        y = np.clip(edge * side + origin[1], low[k, 1], high[k, 1])
        x.append(s[k, 0] + (y - s[k, 1]) * (s[k, 2] - s[k, 0]) / np.where(level, 1, rise))
    left, right = np.where(level, low[k, 0], np.minimum(*x)), np.where(level, high[k, 0], np.maximum(*x))
    begin, end = np.floor((left - origin[0]) / side - 1e-6).astype(np.int64), np.floor((right - origin[0]) / side + 1e-6).astype(np.int64)
    r, place = _spread(end - begin + 1)
    cell = row[r] * (1 << 24) + begin[r] + place
    order = np.argsort(cell, kind="stable")
    cell, member = cell[order], k[r][order]
    later = np.searchsorted(cell, cell, "right") - np.arange(len(cell)) - 1
    sums = np.cumsum(later)
    cuts = np.unique(np.concatenate([[0], np.searchsorted(sums, np.arange(PAIRS, sums[-1] + PAIRS, PAIRS), "left") + 1, [len(cell)]])).clip(0, len(cell))
    for a, b in zip(cuts, cuts[1:], strict=False):
        i, place = _spread(later[a:b])
        if len(i):
            yield member[a + i], member[a + i + 1 + place]


def crosses_itself(geometry) -> bool:
    """True if two segments cross, or overlap along a stretch. Only pairs that go through one cell of a grid are tried, and the
    first crossing ends the search."""
    s = _segments(geometry)
    if len(s) < 2:
        return False
    s = s - np.tile(s[0, :2], 2)
    side = lambda p, q, r: (q[:, 0] - p[:, 0]) * (r[:, 1] - p[:, 1]) - (q[:, 1] - p[:, 1]) * (r[:, 0] - p[:, 0])
    for i, j in near_pairs(s):
        i, j = i[i != j], j[i != j]
        a, b, c, d = s[i, :2], s[i, 2:], s[j, :2], s[j, 2:]
        s1, s2, s3, s4 = side(a, b, c), side(a, b, d), side(c, d, a), side(c, d, b)
        if ((s1 * s2 < 0) & (s3 * s4 < 0)).any():
            return True
        flat = (s1 == 0) & (s2 == 0)
        if flat.any():
            a, axis, c, d = a[flat], (b - a)[flat], c[flat], d[flat]
            u, v = ((c - a) * axis).sum(1), ((d - a) * axis).sum(1)
            if (np.minimum(np.maximum(u, v), (axis * axis).sum(1)) > np.maximum(np.minimum(u, v), 0)).any():
                return True
    return False


def _batches(sizes: list[int], few: int) -> Iterator[list[int]]:
    """Places of the sizes up to `few`, in stretches of about TOGETHER in sum, or TRIED pairs if those are fewer."""
    now, total, pairs = [], 0, 0
    for i, n in enumerate(sizes):
        if n <= few:
            now.append(i)
            total += n
            pairs += n * (n - 1) // 2
            if total >= TOGETHER or pairs >= TRIED:
                yield now
                now, total, pairs = [], 0, 0
    if now:
        yield now


def _within(scene: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows that have one scene; rows are in the order of their scenes."""
    i, place = _spread(np.searchsorted(scene, scene, "right") - np.arange(len(scene)) - 1)
    return i, i + 1 + place


def all_crossing(geometries: list) -> list[bool]:
    """`crosses_itself` of each geometry; those of few edges are tried together."""
    segments = [_segments(g) for g in geometries]
    sizes = [len(s) for s in segments]
    out = [n > FEW and crosses_itself(g) for n, g in zip(sizes, geometries, strict=True)]
    side = lambda p, q, r: (q[:, 0] - p[:, 0]) * (r[:, 1] - p[:, 1]) - (q[:, 1] - p[:, 1]) * (r[:, 0] - p[:, 0])
    for places in _batches(sizes, FEW):
        places = [p for p in places if sizes[p] > 1]
        if not places:
            continue
        s = np.concatenate([segments[p] - np.tile(segments[p][0, :2], 2) for p in places])
        scene = np.repeat(np.arange(len(places)), [sizes[p] for p in places])
        i, j = _within(scene)
        a, b, c, d = s[i, :2], s[i, 2:], s[j, :2], s[j, 2:]
        s1, s2, s3, s4 = side(a, b, c), side(a, b, d), side(c, d, a), side(c, d, b)
        axis = b - a
        u, v = ((c - a) * axis).sum(1), ((d - a) * axis).sum(1)
        along = (s1 == 0) & (s2 == 0) & (np.minimum(np.maximum(u, v), (axis * axis).sum(1)) > np.maximum(np.minimum(u, v), 0))
        for k in np.unique(scene[i[((s1 * s2 < 0) & (s3 * s4 < 0)) | along]]):
            out[places[k]] = True
    return out


def overlay(layers: list, keep, snap_to: float = SNAP) -> list:
    """Polygons of the plane's part where `keep(inside)` holds, inside being each layer's even-odd coverage at a
    point. `keep` is asked once for each combination of layers."""
    return overlay_groups([[g] for g in layers], keep, snap_to)


def _crossings(s: np.ndarray) -> np.ndarray:
    """The heights at which segments cross."""
    return np.concatenate([np.zeros(0), *(np.unique(_met(s, i, j)[1]) for i, j in near_pairs(s))])


def _met(s: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of segments those that cross: (the first one, the height)."""
    near = (s[j, 1] < s[i, 3]) & (s[j, 3] > s[i, 1])
    i, j = i[near], j[near]
    p, q = s[i], s[j]
    d1, d2, w = p[:, 2:] - p[:, :2], q[:, 2:] - q[:, :2], q[:, :2] - p[:, :2]
    den = d1[:, 0] * d2[:, 1] - d1[:, 1] * d2[:, 0]
    ok = den != 0
    i, d1, d2, w, den, y = i[ok], d1[ok], d2[ok], w[ok], den[ok], p[ok, 1]
    u, v = (w[:, 0] * d2[:, 1] - w[:, 1] * d2[:, 0]) / den, (w[:, 0] * d1[:, 1] - w[:, 1] * d1[:, 0]) / den
    hit = (u >= 0) & (u <= 1) & (v >= 0) & (v <= 1)
    return i[hit], y[hit] + u[hit] * d1[hit, 1]


def overlay_groups(groups: list[list], keep, snap_to: float = SNAP) -> list:
    """`overlay` of groups of geometries: a point is inside a group if it is inside one of its geometries.

    A slab decomposition: all ends and crossings cut the plane into horizontal slabs; in a slab the edges are ordered,
    and between two neighbours the coverage is constant. Crossings come from pairs of edges that are near, and all slabs
    are ordered and summed up at once, SLABS rows at a time: the work grows with the edges and the slabs that they span,
    not with their square. The trapezoids that are kept are joined again.
    """
    shapes = [(k, g) for k, group in enumerate(groups) for g in group]
    o = next((np.array(r[0], float) for _, g in shapes for p in g for r in p if len(r)), None)
    if o is None:
        return []
    rows, owner, group_of = [], [], np.array([k for k, _ in shapes])
    for n, (_, g) in enumerate(shapes):
        s = _segments(g)
        s = np.round((s - np.tile(o, 2)) / snap_to) * snap_to
        s = s[s[:, 1] != s[:, 3]]
        rows.append(np.where((s[:, 1] < s[:, 3])[:, None], s, s[:, [2, 3, 0, 1]]))
        owner.append(np.full(len(s), n))
    s, owner = np.concatenate(rows), np.concatenate(owner)
    if not len(s):
        return []
    ys = np.unique(np.concatenate([s[:, 1], s[:, 3], _crossings(s)]))
    ys = ys[np.concatenate([[True], np.diff(ys) > snap_to / 1000])]
    first = np.searchsorted(ys[:-1], s[:, 1] - snap_to / 2000, "left")
    spans = (np.searchsorted(ys[1:], s[:, 3] + snap_to / 2000, "right") - first).clip(0)
    in_slab = np.cumsum(np.bincount(first, minlength=len(ys)) - np.bincount(first + spans, minlength=len(ys))[: len(ys)])
    cuts = np.unique(np.concatenate([[0], np.searchsorted(np.cumsum(in_slab), np.arange(SLABS, in_slab.sum() + SLABS, SLABS), "left") + 1, [len(ys) - 1]])).clip(0, len(ys) - 1)
    wanted = np.array([bool(keep([bool(c >> g & 1) for g in range(len(groups))])) for c in range(1 << len(groups))])
    pieces: list[tuple] = []  # (lower line, left and right below, left and right above)
    for a, b in zip(cuts, cuts[1:], strict=False):
        pieces += _pieces(s, owner, group_of, len(groups), ys, first, spans, a, b, wanted, snap_to)
    return _joined(pieces, ys, o, snap_to)


def _pieces(s, owner, group_of, groups: int, ys, first, spans, a: int, b: int, wanted, snap_to: float) -> Iterator[tuple]:
    """The trapezoids of slabs a to b that are kept: (lower line, left and right below, left and right above)."""
    slope = (s[:, 2] - s[:, 0]) / (s[:, 3] - s[:, 1])
    here = np.flatnonzero((first < b) & (first + spans > a))
    low_k, n = np.maximum(first[here], a), np.minimum(first[here] + spans[here], b) - np.maximum(first[here], a)
    e = np.repeat(here, n)
    k = np.repeat(low_k, n) + np.arange(len(e)) - np.repeat(np.cumsum(n) - n, n)
    low, high = s[e, 0] + (ys[k] - s[e, 1]) * slope[e], s[e, 0] + (ys[k + 1] - s[e, 1]) * slope[e]
    mid = (low + high) / 2
    # In a slab the edges of a geometry enter and leave it by turns.
    turn = np.lexsort((mid, owner[e], k))
    fresh = np.concatenate([[True], (k[turn][1:] != k[turn][:-1]) | (owner[e][turn][1:] != owner[e][turn][:-1])])
    place = np.arange(len(e)) - np.maximum.accumulate(np.where(fresh, np.arange(len(e)), 0))
    step = np.empty(len(e), np.int64)
    step[turn] = 1 - 2 * (place % 2)
    order = np.lexsort((mid, k))
    e, k, low, high, mid, step = (x[order] for x in (e, k, low, high, mid, step))
    begin = np.concatenate([[True], k[1:] != k[:-1]])
    last = np.concatenate([begin[1:], [True]])
    combination = np.zeros(len(e), np.int64)
    for g in range(groups):
        total = np.cumsum(np.where(group_of[owner[e]] == g, step, 0))
        start = np.maximum.accumulate(np.where(begin, np.arange(len(e)), 0))
        combination |= (total - np.where(start > 0, total[start - 1], 0) > 0).astype(np.int64) << g
    kept = wanted[combination] & ~last
    before = np.concatenate([[False], kept[:-1]]) & ~begin
    left, right = np.flatnonzero(kept & ~before), np.flatnonzero(~kept & before)
    wide = mid[right] - mid[left] > snap_to / 1000
    left, right = left[wide], right[wide]
    return zip(*(x.tolist() for x in (k[left], low[left], low[right], high[left], high[right])), strict=True)


def overlay_each(scenes: list[list], keep, snap_to: float = SNAP) -> list[list]:
    """`overlay` of the layers of each of many scenes, all of which have as many layers."""
    return overlay_groups_each([[[g] for g in layers] for layers in scenes], keep, snap_to, FEW)


def overlay_groups_each(scenes: list[list[list]], keep, snap_to: float = SNAP, few: int = MANY) -> list[list]:
    """`overlay_groups` of each of many scenes, all of which have as many groups. Scenes of few edges are cut into slabs
    together: lines and slabs of all of them are numbered through, so nothing of one meets another."""
    if not scenes:
        return []
    segments = [[_segments(g) for group in groups for g in group] for groups in scenes]
    sizes = [sum(map(len, parts)) for parts in segments]
    out = [overlay_groups(layers, keep, snap_to) if n > few else [] for n, layers in zip(sizes, scenes, strict=True)]
    groups = len(scenes[0])
    wanted = np.array([bool(keep([bool(c >> g & 1) for g in range(groups)])) for c in range(1 << groups)])
    for places in _batches(sizes, few):
        places = [p for p in places if sizes[p]]
        if not places:
            continue
        origins = np.array([next(x[0, :2] for x in segments[p] if len(x)) for p in places])
        s = np.concatenate([x for p in places for x in segments[p]])
        group_of = np.array([k for p in places for k, group in enumerate(scenes[p]) for _ in group])
        of_scene = np.repeat(np.arange(len(places)), [len(segments[p]) for p in places])
        owner = np.repeat(np.arange(len(of_scene)), [len(x) for p in places for x in segments[p]])
        scene = of_scene[owner]
        s = np.round((s - np.tile(origins, 2)[scene]) / snap_to) * snap_to
        up = s[:, 1] != s[:, 3]
        s, owner, scene = s[up], owner[up], scene[up]
        if not len(s):
            continue
        s = np.where((s[:, 1] < s[:, 3])[:, None], s, s[:, [2, 3, 0, 1]])
        which, heights = _met(s, *_within(scene))
        line, ys = np.concatenate([scene, scene, scene[which]]), np.concatenate([s[:, 1], s[:, 3], heights])
        order = np.lexsort((ys, line))
        line, ys = line[order], ys[order]
        fresh = np.concatenate([[True], (np.diff(line) > 0) | (np.diff(ys) > snap_to / 1000)])
        line, ys = line[fresh], ys[fresh]
        begin, end = np.searchsorted(line, scene, "left"), np.searchsorted(line, scene, "right")
        # Each edge looks for its ends among its scene's lines, which are few.
        k, place = _spread(end - begin)
        at = ys[begin[k] + place]
        first = begin + np.bincount(k, at < s[k, 1] - snap_to / 2000, len(s)).astype(np.int64)
        spans = (begin + np.bincount(k, at <= s[k, 3] + snap_to / 2000, len(s)).astype(np.int64) - 1 - first).clip(0)
        found: dict[int, list] = {}
        for piece in _pieces(s, owner, group_of, groups, ys, first, spans, 0, len(ys) - 1, wanted, snap_to):
            found.setdefault(int(line[piece[0]]), []).append(piece)
        for n, pieces in found.items():
            out[places[n]] = _joined(pieces, ys, origins[n], snap_to)
    return out


def _joined(pieces: list[tuple], ys: np.ndarray, origin: np.ndarray, snap_to: float) -> list:
    """Polygons of trapezoids between lines: sides stay, and on each line what only one neighbour covers. Edges have the
    covered ground to their right, so shells run clockwise; where several go on, the sharpest right turn is taken."""
    if len(pieces) == 1 and min(pieces[0][2] - pieces[0][1], pieces[0][4] - pieces[0][3]) > snap_to:
        k, l0, r0, l1, r1 = pieces[0]
        return [[np.array([(l0, ys[k]), (l1, ys[k + 1]), (r1, ys[k + 1]), (r0, ys[k]), (l0, ys[k])]) + origin]]
    lines: dict[int, list[float]] = {}
    for k, l0, r0, l1, r1 in pieces:
        lines.setdefault(k, []).extend((l0, r0))
        lines.setdefault(k + 1, []).extend((l1, r1))
    at: dict[int, np.ndarray] = {}
    for k, xs in lines.items():
        x = np.sort(xs)
        at[k] = x[np.concatenate([[True], np.diff(x) > snap_to / 100])]
    snap = lambda k, x: int(np.searchsorted(at[k], x + snap_to / 200, "right") - 1)
    above = {k: np.zeros(len(x), int) for k, x in at.items()}
    below = {k: np.zeros(len(x), int) for k, x in at.items()}
    out: dict[tuple, list] = {}

    def edge(a: tuple, b: tuple) -> None:
        if a != b:
            out.setdefault(a, []).append(b)

    for k, l0, r0, l1, r1 in pieces:
        a, b, c, d = snap(k, l0), snap(k, r0), snap(k + 1, l1), snap(k + 1, r1)
        edge((k, a), (k + 1, c))
        edge((k + 1, d), (k, b))
        above[k][a:b] += 1
        below[k + 1][c:d] += 1
    for k in at:
        for i in np.flatnonzero((above[k] > 0) != (below[k] > 0)):
            i = int(i)
            edge(*(((k, i), (k, i + 1)) if below[k][i] else ((k, i + 1), (k, i))))
    # Sides that two pieces share run both ways and cancel.
    for a in list(out):
        for b in list(out[a]):
            if b in out[a] and a in out.get(b, ()):
                out[a].remove(b)
                out[b].remove(a)
    place = lambda v: (float(at[v[0]][v[1]] + origin[0]), float(ys[v[0]] + origin[1]))
    rings = []
    for start in sorted(out):
        while out[start]:
            ring, here, came = [start], start, None
            while True:
                options = out[here]
                if came is None or len(options) == 1:
                    to = options[0]
                else:
                    p, q = place(came), place(here)
                    turn = lambda v: np.arctan2((q[0] - p[0]) * (place(v)[1] - q[1]) - (q[1] - p[1]) * (place(v)[0] - q[0]), (q[0] - p[0]) * (place(v)[0] - q[0]) + (q[1] - p[1]) * (place(v)[1] - q[1]))  # noqa: E731, B023
                    to = min(options, key=turn)
                options.remove(to)
                came, here = here, to
                if here == start:
                    break
                ring.append(here)
                if not out.get(here):
                    ring = []
                    break
            p = [place(v) for v in ring]
            flat = lambda u, v, w: abs((v[0] - u[0]) * (w[1] - v[1]) - (v[1] - u[1]) * (w[0] - v[0])) <= 1e-9 * (1 + abs(w[0] - u[0]) + abs(w[1] - u[1]))
            p = [v for u, v, w in zip([*p[-1:], *p[:-1]], p, [*p[1:], *p[:1]], strict=True) if not flat(u, v, w)]
            if len(p) >= 3:
                rings.append([*p, p[0]])
    size = lambda r: sum((a[0] - r[0][0]) * (b[1] - r[0][1]) - (b[0] - r[0][0]) * (a[1] - r[0][1]) for a, b in zip(r, r[1:], strict=False)) / 2
    holds = lambda r, p: sum((a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(r, r[1:], strict=False)) % 2 == 1
    shells = [[r] for r in rings if size(r) < 0]
    for r in rings:
        if size(r) > 0:
            a, b = r[0], r[1]
            n = np.hypot(b[0] - a[0], b[1] - a[1])
            probe = ((a[0] + b[0]) / 2 + (b[1] - a[1]) / n * snap_to / 10, (a[1] + b[1]) / 2 - (b[0] - a[0]) / n * snap_to / 10)  # just outside the hole
            owner = min((s for s in shells if holds(s[0], probe)), key=lambda s: -size(s[0]), default=None)
            if owner is not None:
                owner.append(r)
    return [[np.array(r) for r in s] for s in shells]


def is_simple(geometry: Column) -> Column:
    """False for a geometry whose edges cross or overlap; cheap checks of its rings come first. Null for null."""
    return F.when(G.ring_problems(geometry), F.lit(False)).otherwise(holds_by_batch(lambda gs: [not c for c in all_crossing(gs)], geometry))


def tidied(polygon) -> list:
    """Rings without repeated points, closed; those with fewer than four points are left out."""
    out = []
    for ring in polygon:
        r = np.asarray(ring, float)
        if len(r):
            same = (r[1:] == r[:-1]).all(1)
            r = r[np.concatenate([[True], ~same])] if same.any() else r
        if len(r) and (r[0] != r[-1]).any():
            r = np.concatenate([r, r[:1]])
        if len(r) >= 4:
            out.append(r)
    return out


def _thin_short(ring: list, tolerance: float) -> list[int]:
    """The points of a short ring that `thin` keeps, without numpy, whose calls cost more than so few points."""
    ox, oy = ring[0]
    far = max(range(len(ring)), key=lambda i: hypot(ring[i][0] - ox, ring[i][1] - oy))
    keep = {0, far, len(ring) - 1}
    todo = [(0, far), (far, len(ring) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        (x, y), dx, dy = ring[a], ring[b][0] - ring[a][0], ring[b][1] - ring[a][1]
        size = hypot(dx, dy)
        dist = [abs(dx * (v - y) - dy * (u - x)) / size if size else hypot(u - x, v - y) for u, v in ring[a + 1 : b]]
        most = max(dist)
        if most > tolerance:
            k = a + 1 + dist.index(most)
            keep.add(k)
            todo += [(a, k), (k, b)]
    return sorted(keep)


def thin(ring, tolerance: float) -> np.ndarray:
    p = np.asarray(ring, float)
    if 0 < len(p) <= FEW:
        kept = _thin_short(p.tolist(), tolerance)
        return p[kept] if len(kept) >= 4 else p
    keep = np.zeros(len(p), bool)
    far = int(np.hypot(*(p - p[0]).T).argmax())
    keep[[0, far, len(p) - 1]] = True
    todo = [(0, far), (far, len(p) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        d = p[b] - p[a]
        w = p[a + 1 : b] - p[a]
        size = np.hypot(*d)
        dist = abs(d[0] * w[:, 1] - d[1] * w[:, 0]) / size if size else np.hypot(*w.T)
        k = int(dist.argmax())
        if dist[k] > tolerance:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return p[keep] if keep.sum() >= 4 else p


def thinned(geometry, tolerance: float = 1e-6) -> list:
    """Each ring thinned; a geometry that would cross itself then stays as it is."""
    new = [[thin(r, tolerance) for r in p] for p in geometry]
    return geometry if crosses_itself(new) else new


def all_thinned(geometries: list, tolerance: float = 1e-6) -> list:
    """`thinned` of each geometry."""
    new = [[[thin(r, tolerance) for r in p] for p in g] for g in geometries]
    return [g if crossed else n for g, n, crossed in zip(geometries, new, all_crossing(new), strict=True)]


def repaired(geometry: Column, snap_to: float = SNAP) -> Column:
    """Repeated points and short rings dropped, rings closed; what still crosses itself is cut and rebuilt by even-odd
    coverage. Null if nothing is left."""

    def work(given):
        out = [[rings for p in g if (rings := tidied(p))] for g in given]
        cut = [i for i, c in enumerate(all_crossing(out)) if c]
        for i, g in zip(cut, overlay_each([[out[i]] for i in cut], lambda inside: inside[0], snap_to), strict=True):
            out[i] = g
        return [g or None for g in out]

    return by_batch(work, geometry)


def simplified(geometry: Column, tolerance: float = 1e-6) -> Column:
    """Points within `tolerance` of the line between those kept are dropped; a ring that would become too short, or a
    geometry that would cross itself, stays as it is."""
    return by_batch(lambda given: all_thinned(given, tolerance), geometry)


def _empty_for_null(geometry: Column) -> Column:
    return F.coalesce(geometry, F.array().cast(G.GEOMETRY))


def difference(a: Column, b: Column) -> Column:
    """What is in `a` and not in `b`, of one row's geometries; a null one is empty."""
    return by_batch(lambda x, y: overlay_each(list(zip(x, y, strict=True)), lambda i: i[0] and not i[1]), _empty_for_null(a), _empty_for_null(b))


def intersection(a: Column, b: Column) -> Column:
    """What is in both of one row's geometries; null if one is null."""
    return by_batch(lambda x, y: overlay_each(list(zip(x, y, strict=True)), all), a, b)


def union_in_tiles(df: DataFrame, size: float, by: list[str], geometry: str = "geometry", rank: str | None = None) -> DataFrame:
    """Union of a layer's features by tile: (by, tile, geometry), the pieces of each tile clipped to it.

    A feature goes to each tile that it touches; a tile's pieces are united and clipped in one overlay, copies
    once, so a task holds the features of a few tiles. Tiles of `size` must be small enough for that. Pieces of neighbouring tiles share the tile's edge.
    With `rank`, one of the columns `by`, layers that differ in it alone take ground from each other: each gets its union
    without the unions of those with a smaller rank.
    """
    from terraloom.operators.spatial import assign_tiles

    group = [c for c in by if c != rank]

    def work(rows: pa.Table, begins: list[int]) -> pa.Table:
        ranks = rows[rank].to_pylist() if rank else [0] * len(rows)
        shapes, tx, ty = shapes_of(rows["g"]), rows["tx"].to_pylist(), rows["ty"].to_pylist()
        scenes, first = [], []
        for a, b in zip(begins, [*begins[1:], len(rows)], strict=True):
            x, y = tx[a] * size, ty[a] * size
            tile = [[np.array([(x + i * size, y + j * size) for i, j in ((0, 0), (0, 1), (1, 1), (1, 0), (0, 0))])]]
            taken: list = []
            for r in sorted(set(ranks[a:b])):
                mine = [i for i in range(a, b) if ranks[i] == r]
                own = list({tuple(np.asarray(ring).tobytes() for p in shapes[i] for ring in p): shapes[i] for i in mine}.values())
                scenes.append([own, [tile], taken])
                taken = taken + own
                first.append(mine[0])
        out = overlay_groups_each(scenes, lambda i: i[0] and i[1] and not i[2])
        return rows.select([*by, "tx", "ty"]).take(first).append_column("geometry", column_of(out))

    rows = assign_tiles(df.select(*by, F.col(geometry).alias("g")).where(F.size("g") > 0), size, "g").select(*by, "tile.tx", "tile.ty", "g")
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by) + f", tx long, ty long, geometry {G.GEOMETRY}"
    return whole_groups(rows.where(F.col(rank).isNotNull() if rank else F.lit(True)), [*group, "tx", "ty"], work, schema).where("size(geometry) > 0")


def _open_edges(pieces: DataFrame, size: float, by: list[str]) -> DataFrame:
    """(by, ax, ay, bx, by_) in millimetres: directed edges of the pieces, covered ground to the right, without the seams
    between tiles. What lies on a tile's line is summed up along it; where both sides are covered nothing is left."""
    side = round(size * 1000)
    mm = lambda c: F.round(F.col(f"e.{c}") * 1000).cast("long")
    e = pieces.select(*by, F.explode(G.edges_of(F.col("geometry"))).alias("e")).select(*by, mm("x1").alias("ax"), mm("y1").alias("ay"), mm("x2").alias("bx"), mm("y2").alias("by_")).where("ax <> bx OR ay <> by_")
    upright, level = (F.col("ax") == F.col("bx")) & (F.col("ax") % side == 0), (F.col("ay") == F.col("by_")) & (F.col("ay") % side == 0)
    start, stop = F.when(upright, F.col("ay")).otherwise(F.col("ax")), F.when(upright, F.col("by_")).otherwise(F.col("bx"))
    way = F.when(stop > start, 1).otherwise(-1)
    seam = e.where(upright | level).select(*by, upright.alias("upright"), F.when(upright, F.col("ax")).otherwise(F.col("ay")).alias("line"), F.floor(F.least(start, stop) / side).alias("cell"), F.array(F.struct(F.least(start, stop).alias("at"), way.alias("d")), F.struct(F.greatest(start, stop).alias("at"), (-way).alias("d"))).alias("ends"))
    key = [*by, "upright", "line", "cell"]
    sums = seam.select(*key, F.explode("ends").alias("p")).groupBy(*key, "p.at").agg(F.sum("p.d").alias("d"))
    w = Window.partitionBy(*key).orderBy("at")
    left = sums.select(*key, "at", F.sum("d").over(w).alias("net"), F.lead("at").over(w).alias("to")).where("net <> 0 AND to IS NOT NULL")
    first, last = F.when(F.col("net") > 0, F.col("at")).otherwise(F.col("to")), F.when(F.col("net") > 0, F.col("to")).otherwise(F.col("at"))
    x = lambda v: F.when(F.col("upright"), F.col("line")).otherwise(v)
    y = lambda v: F.when(F.col("upright"), v).otherwise(F.col("line"))
    border = left.select(*by, x(first).alias("ax"), y(first).alias("ay"), x(last).alias("bx"), y(last).alias("by_"))
    return e.where(~(upright | level)).unionByName(border)


def _walk(edges: np.ndarray) -> list[np.ndarray]:
    """Closed rings of directed edges; where several go on, the sharpest right turn is taken. Points between two edges of
    one direction are left out."""
    out: dict[tuple, list] = {}
    for ax, ay, bx, by in edges.tolist():
        out.setdefault((ax, ay), []).append((bx, by))
    rings = []
    for start in sorted(out):
        while out[start]:
            ring, here, came = [start], start, None
            while True:
                options = out.get(here)
                if not options:
                    ring = []
                    break
                if came is None or len(options) == 1:
                    to = options[0]
                else:
                    u, v = here[0] - came[0], here[1] - came[1]
                    to = min(options, key=lambda p: np.arctan2(u * (p[1] - here[1]) - v * (p[0] - here[0]), u * (p[0] - here[0]) + v * (p[1] - here[1])))  # noqa: B023
                options.remove(to)
                came, here = here, to
                if here == start:
                    break
                ring.append(here)
            p = [v for u, v, w in zip([*ring[-1:], *ring[:-1]], ring, [*ring[1:], *ring[:1]], strict=True) if (v[0] - u[0]) * (w[1] - v[1]) != (v[1] - u[1]) * (w[0] - v[0])]
            if len(p) >= 3:
                rings.append(np.array([*p, p[0]], float) / 1000)
    return rings


def dissolved_parts(df: DataFrame, size: float, by: list[str], geometry: str = "geometry", rank: str | None = None) -> DataFrame:
    """(by, geometry): the union of each layer as single polygons, without seams; layers with a `rank` as in
    `union_in_tiles`. Repeated and overlapping features count once. `size` is in whole millimetres.

    Tiles are united by themselves, seams cancel by sums along the tiles' lines, and the edges that stay are grouped to
    connected chains by joins: a task holds a few tiles, or the chains of a few rings and those that touch them. Holes go to the
    smallest ring around them among those whose box touches their tile.
    """
    from terraloom.operators.spatial import tiles_of

    pieces = checkpointed(union_in_tiles(df, size, by, geometry, rank))
    node = lambda x, y: F.xxhash64(*by, F.col(x), F.col(y))
    edges = checkpointed(_open_edges(pieces, size, by).withColumns({"src": node("ax", "ay"), "dst": node("bx", "by_")}))
    chains = connected_components(edges.select("src", "dst")).select(F.col("node").alias("src"), "component")

    def rings(rows: pa.Table, begins: list[int]) -> pa.Table:
        ends = np.stack([rows[c].to_numpy() for c in ("ax", "ay", "bx", "by_")], 1)
        found = [(a, ring) for a, b in zip(begins, [*begins[1:], len(rows)], strict=True) for ring in _walk(ends[a:b])]
        return rows.select(by).take([a for a, _ in found]).append_column("ring", column_of([[[r]] for _, r in found]))

    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in by)
    found = whole_groups(edges.join(chains, "src"), [*by, "component"], rings, f"{kinds}ring {G.GEOMETRY}")
    found = checkpointed(found.withColumn("ring", F.get(F.get("ring", F.lit(0)), F.lit(0))).withColumns({"area": G.signed_area(F.col("ring")), "ring_id": F.xxhash64(*by, "ring")}))
    shells, holes = found.where("area < 0"), found.where("area > 0")
    tiles = tiles_of(G.bbox(F.array(F.array("ring"))), size)
    a, b = F.get("ring", F.lit(0)), F.get("ring", F.lit(1))
    # A point on the covered side of the hole's first edge.
    far = F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"])) * 10000
    probe = F.struct(((a["x"] + b["x"]) / 2 + (b["y"] - a["y"]) / far).alias("x"), ((a["y"] + b["y"]) / 2 - (b["x"] - a["x"]) / far).alias("y"))
    asked = holes.select(*by, F.col("ring").alias("hole"), "ring_id", probe.alias("p")).withColumn("tile", F.struct(F.floor(F.col("p.x") / size).alias("tx"), F.floor(F.col("p.y") / size).alias("ty")))
    near = shells.select(*by, F.col("ring").alias("shell"), F.col("ring_id").alias("owner"), (-F.col("area")).alias("area"), F.explode(tiles).alias("tile"))
    inside = G.contains(F.col("shell"), F.col("p"))
    owned = asked.join(near, [*by, "tile"]).where(inside).groupBy("ring_id").agg(F.min_by("owner", "area").alias("owner"), F.first("hole").alias("hole"))
    by_shell = owned.groupBy("owner").agg(F.array_sort(F.collect_list("hole")).alias("holes"))
    parts = shells.join(by_shell, shells["ring_id"] == by_shell["owner"], "left")
    return parts.select(*by, F.array(F.concat(F.array("ring"), F.coalesce("holes", F.array()))).alias("geometry"))


def standard_pipeline(df: DataFrame, geometry: str = "geometry", srid: int = 25832) -> DataFrame:
    """The gate for whole batches: repair, to degrees, repair again; any geometry that isn't simple then is an error, null
    and empty ones are dropped. The second repair snaps to 1e-9 degrees, a tenth of a millimetre."""
    g = F.col(geometry) if srid == 25832 else crs.transformed(F.col(geometry), crs.to_utm32)
    out = df.withColumn(geometry, repaired(g)).where(F.col(geometry).isNotNull())
    out = out.withColumn(geometry, repaired(crs.transformed(F.col(geometry), crs.to_wgs84), 1e-9))
    ok = unused(out, "ok")
    out = out.withColumn(ok, is_simple(F.col(geometry)))
    checked = F.when(F.col(ok), F.col(geometry)).otherwise(F.raise_error(F.lit("a geometry is not valid after repair")))
    return out.withColumn(geometry, checked).drop(ok).withColumn("srid", F.lit(4326))


def filtering_pipeline(df: DataFrame, wkb: str = "geometry", min_points: int = 4, min_area: float = 1.0, max_area: float = 1e8) -> DataFrame:
    """WKB in degrees to valid features with box, centre, points and area in square metres; others are dropped.

    Decoding, thinning and the test for crossings are one Python step; measures and rules are native.
    """
    names = [c for c in df.columns if c != wkb]

    def run(batches):
        for batch in batches:
            found = [decode_one(b) for b in batch.column(wkb).to_pylist()]
            found = all_thinned([[tidied(p) for p in g] if g is not None else [] for g in found])
            good = [len(g) > 0 and all(map(len, g)) and all(len(r) >= 4 for p in g for r in p) and not crossed for g, crossed in zip(found, all_crossing(found), strict=True)]
            kept = batch.select(names).filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*kept.columns, column_of([g for g, ok in zip(found, good, strict=True) if ok])], names=[*names, "geometry"])

    schema = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in names) + f"geometry {G.GEOMETRY}"
    g = F.col("geometry")
    centre = unused(df, "centre")
    out = df.mapInArrow(run, schema).withColumns({"num_points": G.n_points(g), "area_m2": G.area(crs.transformed(g, crs.to_utm32)), "bbox": G.bbox(g), centre: G.centroid(g)})
    out = out.where((F.col("num_points") >= min_points) & F.col("area_m2").between(min_area, max_area))
    return out.select(*names, "geometry", "bbox", F.col(f"{centre}.x").alias("center_x"), F.col(f"{centre}.y").alias("center_y"), "num_points", "area_m2")
