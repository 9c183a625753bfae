"""Session helpers shared by the library, its tests and its benchmark."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(cpus: int | str = "*", name: str = "terraloom", shuffle: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, whatever folder the driver was started in."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), ROOT) if x)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: what spark.checkpoint.dir names, or the application's own
    checkpoint folder. On one machine a temporary folder will do; on a cluster it would be scattered, so that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(os.environ.get("TMPDIR", "/tmp"), "terraloom-shared")


def checkpointed(df: DataFrame) -> DataFrame:
    """`df`, computed once and kept in the shared folder: its lineage is cut and losing an executor loses nothing."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints-{uuid.uuid4().hex[:8]}")
    return df.checkpoint(eager=True)


def settled(df: DataFrame) -> DataFrame:
    """`df`, written to the shared folder and read again, for loops that join a table with itself: a checkpoint keeps the
    planner's estimate of its size, which a join multiplies, so that it gets twice as many digits each round until
    planning alone takes minutes; of files the size is known. The rows may be in fewer partitions afterwards."""
    path = f"{shared_dir(df.sparkSession)}/settled-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """`df` dealt over all cores by its keys: for tables of few bytes, which are read in few tasks, before work that is large for
    a row's bytes."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *keys)


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that `df` hasn't, for a helper column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
