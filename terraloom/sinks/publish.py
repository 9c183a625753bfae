"""Publishing datasets: staged, whole, as tables, lines and CSV."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def replace_dir(spark: SparkSession, new: str, target: str) -> None:
    """`new` takes the place of `target`, by renames, on whatever file system they are.

    The last good table is kept beside it (.old) until the new one stands; if that fails, it is put back. Between the two
    renames readers find no table. A table that an interrupted run has left as .old only is put back first.
    """
    p, fs = _path(spark, target)
    old, source = _path(spark, f"{target}.old")[0], _path(spark, new)[0]
    if not fs.exists(source):
        raise FileNotFoundError(new)
    if fs.exists(old) and not fs.exists(p):
        _rename(fs, old, p)
    if fs.exists(p):
        fs.delete(old, True)
        _rename(fs, p, old)
    try:
        _rename(fs, source, p)
    except Exception:
        if fs.exists(old) and not fs.exists(p):
            _rename(fs, old, p)
        raise
    fs.delete(old, True)


def _rename(fs, a, b) -> None:
    if not fs.rename(a, b):
        raise OSError(f"could not rename {a} to {b}")


def write_counted(df: DataFrame, path: str) -> int:
    """Write to `path` and return the rows, counted as they are written and not by a second pass."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def listed(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def publish_version(df: DataFrame, root: str, dataset: str, keep: int = 3, at: datetime | None = None) -> int:
    """A new version of a dataset, and its rows; readers (`read_current`) find the last version or this one, never none.

    A version is a folder that nobody changes once it stands. Its pointer is an empty file whose name has its number and
    the folder's; the version is the current one from the moment when that file is made, which is one step in any file
    system. The newest `keep` versions stay for those that read them, older ones go. An empty dataset is not published: 0.
    Each version leaves a line in the run log (`run_log`). Of two publications at a time both stand, and one of them is current.
    """
    spark, base = df.sparkSession, f"{root}/raw/{dataset}"
    name = uuid.uuid4().hex[:12]
    rows = write_counted(df, f"{base}/versions/{name}")
    if not rows:
        remove(spark, f"{base}/versions/{name}")
        return 0
    pointers = listed(spark, f"{base}/pointers")
    number = int(pointers[-1].split("-")[0]) + 1 if pointers else 1
    p, fs = _path(spark, f"{base}/pointers/{number:012d}-{name}")
    fs.create(p, False).close()
    log = spark.createDataFrame([(dataset, number, name, rows, at)], "dataset string, version long, folder string, rows long, at timestamp")
    log.coalesce(1).write.mode("append").json(f"{base}/runs")
    for old in [*pointers, p.getName()][:-keep]:
        remove(spark, f"{base}/pointers/{old}")
        remove(spark, f"{base}/versions/{old.split('-')[1]}")
    return rows


def read_current(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """The current version of a dataset. The frame stays with its version, whatever is published later."""
    pointers = listed(spark, f"{root}/raw/{dataset}/pointers")
    if not pointers:
        raise FileNotFoundError(f"{root}/raw/{dataset}")
    return spark.read.parquet(f"{root}/raw/{dataset}/versions/{pointers[-1].split('-')[1]}")


def run_log(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """(dataset, version, folder, rows, at) of each publication."""
    return spark.read.schema("dataset string, version long, folder string, rows long, at timestamp").json(f"{root}/raw/{dataset}/runs")


def publish(df: DataFrame, root: str, dataset: str, name: str = "current") -> bool:
    """Write to <root>/raw/<dataset>/<name>.parquet whole, or not at all; an empty dataset is not published."""
    target = f"{root}/raw/{dataset}/{name}.parquet"
    if not write_counted(df, f"{target}.new"):
        remove(df.sparkSession, f"{target}.new")
        return False
    replace_dir(df.sparkSession, f"{target}.new", target)
    return True


def publish_all(frames: Mapping[str, DataFrame], root: str) -> dict[str, bool]:
    return {name: publish(df, root, name) for name, df in frames.items()}


def stage(df: DataFrame, root: str, dataset: str) -> None:
    """Append a page to the dataset's working table."""
    df.write.mode("append").parquet(f"{root}/raw/{dataset}/working.parquet")


def promote(spark: SparkSession, root: str, dataset: str, missing: DataFrame) -> bool:
    """The working table becomes the current one if no expected page is missing; otherwise it stays. One that a stream has
    written lists its files by their paths, so it is written anew instead of renamed."""
    working = f"{root}/raw/{dataset}/working.parquet"
    if not exists(spark, working) or not missing.isEmpty():
        return False
    if exists(spark, f"{working}/_spark_metadata"):
        publish(spark.read.parquet(working), root, dataset)
        remove(spark, working)
    else:
        replace_dir(spark, working, f"{root}/raw/{dataset}/current.parquet")
    return True


def geo_publish(df: DataFrame, path: str, srid: int, geometry: str = "geometry") -> None:
    """Snappy Parquet of a WKB column, with a sidecar that states its encoding and reference system."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    meta = {"version": "1.0.0", "primary_column": geometry, "columns": {geometry: {"encoding": "WKB", "crs": f"EPSG:{srid}"}}}
    spark = df.sparkSession
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}_geo_metadata")


def geo_srid(spark: SparkSession, path: str) -> str:
    """The reference system that the sidecar states."""
    meta = json.loads(spark.read.text(f"{path}_geo_metadata").head().value)
    return meta["columns"][meta["primary_column"]]["crs"]


def write_lines(df: DataFrame, root: str, stem: str, run: datetime) -> str:
    path = f"{root}/{stem}_{run:%Y%m%d_%H%M%S}.ndjson"
    df.write.mode("overwrite").json(path)
    return path


def load_table(df: DataFrame, table: str) -> int:
    """Replace a table and return its rows, counted as they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").saveAsTable(table)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str) -> None:
    """All fields quoted, UTF-8."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("encoding", "UTF-8").csv(path)


def export_records(df: DataFrame, path: str, updated: datetime) -> None:
    """Records as JSON lines, and a line about their age beside them."""
    df.write.mode("overwrite").json(f"{path}/records")
    row = df.sparkSession.createDataFrame([(updated,)], "last_updated timestamp").withColumn("next_update", F.expr("last_updated + interval 7 days"))
    row.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
