"""Polygons in Parquet whose own footers state encoding, reference system, kinds of geometry and bounds."""

from __future__ import annotations

import json
import os
import posixpath
import uuid
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as files
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from terraloom.functions import geometry as G
from terraloom.functions import wkb
from terraloom.session import prepare, unused
from terraloom.sinks.publish import remove, replace_dir

#: Kinds of geometry by their number in WKB.
KINDS = {3: "Polygon", 6: "MultiPolygon"}
SIDES = ("xmin", "ymin", "xmax", "ymax")
#: Bytes of rows that a row group collects before it is written, so that a task's memory has a bound.
GROUP_BYTES = 64 << 20


def file_system(path: str) -> tuple[files.FileSystem, str]:
    """The file system of a path that Spark or a user gives, and the path in it."""
    if urlparse(path).scheme in ("", "file"):
        return files.LocalFileSystem(), unquote(urlparse(path).path) if path.startswith("file:") else os.path.abspath(path)
    return files.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    """The file that a task has left in the staging folder; None if it had no rows."""

    file: str | None


class GeoWriter(DataSourceArrowWriter):
    """Each task writes one file to a staging folder; the driver moves those of the tasks that count, so what a lost or repeated
    task leaves is never seen."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.geometry, self.box, self.srid = options["path"], options["geometry"], options["box"], int(options["srid"])
        self.overwrite, self.job = overwrite, uuid.uuid4().hex[:12]

    def _staging(self, root: str) -> str:
        return posixpath.join(root, f"_staging-{self.job}")

    def write(self, iterator) -> Written:
        system, root = file_system(self.path)
        name, writer, held, size = f"part-{self.job}-{uuid.uuid4().hex[:12]}.snappy.parquet", None, [], 0
        sides: dict[str, list] = {s: [] for s in SIDES}
        kinds: set[int] = set()

        def flush():
            if held:
                writer.write_table(pa.Table.from_batches(held))
                held.clear()

        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(self._staging(root))
                writer = pq.ParquetWriter(posixpath.join(self._staging(root), name), batch.schema, filesystem=system, compression="snappy")
            box, shapes = batch.column(self.box), batch.column(self.geometry)
            for s in SIDES:
                edge = (pc.min if s.endswith("min") else pc.max)(pc.struct_field(box, s)).as_py()
                if edge is not None:
                    sides[s].append(edge)
            kinds |= {k[0] for k in pc.unique(pc.binary_slice(shapes, 1, 2)).to_pylist() if k}
            held.append(batch)
            size += batch.nbytes
            if size >= GROUP_BYTES:
                flush()
                size = 0
        if writer is None:
            return Written(None)
        flush()
        bounds = [(min if s.endswith("min") else max)(v) for s, v in sides.items() if v]
        writer.add_key_value_metadata({"geo": json.dumps(self.metadata(kinds, bounds))})
        writer.close()
        return Written(name)

    def metadata(self, kinds: set[int], bounds: list[float]) -> dict:
        """What the footer says of the file: the reference system is named by its number, the bounds' column is stated as the
        geometry's covering."""
        column = {
            "encoding": "WKB",
            "geometry_types": sorted(KINDS[k] for k in kinds),
            "crs": {"id": {"authority": "EPSG", "code": self.srid}},
            "covering": {"bbox": {s: [self.box, s] for s in SIDES}},
        }
        return {"version": "1.1.0", "primary_column": self.geometry, "columns": {self.geometry: column | ({"bbox": bounds} if bounds else {})}}

    def commit(self, messages: list) -> None:
        system, root = file_system(self.path)
        before = [f.path for f in system.get_file_info(files.FileSelector(root, allow_not_found=True)) if f.base_name.endswith(".parquet")]
        for m in messages:
            if m is not None and m.file:
                system.move(posixpath.join(self._staging(root), m.file), posixpath.join(root, m.file))
        for old in before if self.overwrite else []:
            system.delete_file(old)
        self._clear(system, root)

    def abort(self, messages: list) -> None:
        self._clear(*file_system(self.path))

    def _clear(self, system, root: str) -> None:
        if system.get_file_info(self._staging(root)).type == files.FileType.Directory:
            system.delete_dir(self._staging(root))


class GeoParquet(DataSource):
    """`df.write.format("geoparquet")` with the options path, geometry (a WKB column), box (a struct of xmin, ymin, xmax, ymax) and srid.
    The path is in a file system that pyarrow knows (local or mounted, HDFS, S3, GCS)."""

    @classmethod
    def name(cls) -> str:
        return "geoparquet"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return GeoWriter(dict(self.options), overwrite)


def box_of(geometry: Column) -> Column:
    """struct<xmin, ymin, xmax, ymax>; null for null and empty."""
    names = dict(zip(SIDES, ("minx", "miny", "maxx", "maxy"), strict=True))
    return G.let(G.bbox(geometry), lambda b: F.when(b["minx"].isNotNull(), F.struct(*(b[g].alias(s) for s, g in names.items()))))


def write_geo(df: DataFrame, path: str, srid: int, geometry: str = "geometry") -> int:
    """Replace the table at `path` by `df`, its polygons as WKB with their boxes beside them, and return its rows, counted as they are
    written. Null and empty geometries stay as nulls. An empty table is not published: 0, and what was there stays."""
    spark = prepare(df.sparkSession)
    spark.dataSource.register(GeoParquet)
    box, seen, new = unused(df, "bbox"), Observation(), f"{path}.new"
    remove(spark, new)
    out = df.withColumn(box, box_of(F.col(geometry))).withColumn(geometry, wkb.to_wkb(F.col(geometry)))
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"))
    out.write.format("geoparquet").mode("append").option("path", new).option("geometry", geometry).option("box", box).option("srid", srid).save()
    rows = seen.get["rows"]
    if rows:
        replace_dir(spark, new, path)
    return rows


def footers(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, encoding, crs, kinds, covering, xmin, ymin, xmax, ymax) of each file, out of its footer; of the data nothing is
    read. A file without such a footer has nulls."""

    def read_footers(batches):
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                system, inner = file_system(name)
                with system.open_input_file(inner) as f:
                    meta = pq.read_metadata(f)
                geo = json.loads((meta.metadata or {}).get(b"geo", b"null"))
                row = {"file": name, "rows": meta.num_rows}
                if geo:
                    column = geo["columns"][geo["primary_column"]]
                    crs, covering = column.get("crs"), column.get("covering", {}).get("bbox")
                    row |= {"encoding": column["encoding"], "crs": crs and f"{crs['id']['authority']}:{crs['id']['code']}", "kinds": column["geometry_types"]}
                    row |= {"covering": covering and covering["xmin"][0], **dict(zip(SIDES, column.get("bbox", []), strict=False))}
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=shape)

    shape = pa.schema(
        [("file", pa.string()), ("rows", pa.int64()), ("encoding", pa.string()), ("crs", pa.string()), ("kinds", pa.list_(pa.string())), ("covering", pa.string()), *((s, pa.float64()) for s in SIDES)]
    )
    sides = ", ".join(f"{s} double" for s in SIDES)
    found = prepare(spark).read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path")
    return found.mapInArrow(read_footers, f"file string, rows long, encoding string, crs string, kinds array<string>, covering string, {sides}")


def check_srid(spark: SparkSession, path: str, srid: int) -> None:
    """An error if a file states another reference system, or none."""
    other = footers(spark, path).where(~F.col("crs").eqNullSafe(f"EPSG:{srid}")).select("file", "crs").head()
    if other:
        raise ValueError(f"{other.file} is in {other.crs}, not in EPSG:{srid}")


def read_geo(spark: SparkSession, path: str, window: tuple[float, float, float, float] | None = None, geometry: str = "geometry", box: str = "bbox") -> DataFrame:
    """The table with polygons in place of WKB, without its boxes. With a window (xmin, ymin, xmax, ymax), rows whose boxes meet it:
    row groups that lie elsewhere are passed over by their statistics."""
    df = prepare(spark).read.parquet(path)
    if window:
        xmin, ymin, xmax, ymax = window
        b = F.col(box)
        df = df.where((b["xmin"] <= xmax) & (b["xmax"] >= xmin) & (b["ymin"] <= ymax) & (b["ymax"] >= ymin))
    return df.withColumn(geometry, wkb.from_wkb(F.col(geometry))).drop(box)
