"""Well-known binary of polygons, in Arrow batches; the bytes are written and read with numpy."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from terraloom.functions import geometry as G
from terraloom.functions.shapes import column_of, shapes_of


def encode_one(geometry) -> bytes | None:
    """Little-endian WKB: a Polygon if there is one, else a MultiPolygon; None for null or empty."""
    if geometry is None or not len(geometry):
        return None

    def polygon(p) -> bytes:
        out = [struct.pack("<BII", 1, 3, len(p))]
        for ring in p:
            xy = np.asarray(ring, "<f8")
            out += [struct.pack("<I", len(xy)), xy.tobytes()]
        return b"".join(out)

    parts = [polygon(p) for p in geometry]
    return parts[0] if len(parts) == 1 else struct.pack("<BII", 1, 6, len(parts)) + b"".join(parts)


def decode_one(data) -> list | None:
    """Polygons of a Polygon's or MultiPolygon's WKB of either byte order; None for anything else, and for broken bytes."""
    if data is None:
        return None
    data = bytes(data)
    try:

        def polygon(at: int) -> tuple[list, int]:
            end = "<" if data[at] == 1 else ">"
            kind, n = struct.unpack_from(f"{end}II", data, at + 1)
            if kind != 3:
                raise ValueError
            at += 9
            rings = []
            for _ in range(n):
                (k,) = struct.unpack_from(f"{end}I", data, at)
                xy = np.frombuffer(data, f"{end}f8", 2 * k, at + 4).reshape(k, 2)
                rings.append(xy.astype(float))
                at += 4 + 16 * k
            return rings, at

        end = "<" if data[0] == 1 else ">"
        kind, n = struct.unpack_from(f"{end}II", data, 1)
        if kind == 3:
            found, at = polygon(0)
            found = [found]
        elif kind == 6:
            found, at = [], 9
            for _ in range(n):
                p, at = polygon(at)
                found.append(p)
        else:
            return None
        return found if at == len(data) else None
    except (struct.error, ValueError, IndexError):
        return None


def to_wkb(geometry: Column) -> Column:
    def encode(column: pa.Array) -> pa.Array:
        return pa.array([encode_one(s) for s in shapes_of(column)], pa.binary())

    return F.arrow_udf(encode, "binary").asNondeterministic()(geometry)


def from_wkb(data: Column) -> Column:
    def decode(column: pa.Array) -> pa.Array:
        return column_of([decode_one(b) for b in column.to_pylist()])

    return F.arrow_udf(decode, G.GEOMETRY).asNondeterministic()(data)
