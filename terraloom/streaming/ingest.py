"""Incremental ingestion of landed pages with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Work = Callable[[DataFrame], DataFrame]


def ingest(spark: SparkSession, source: str, schema: StructType, target: str, state: str, work: Work | None = None, files_per_batch: int = 100, keys: list[str] | None = None, pattern: str | None = None, late: tuple[str, str] | None = None) -> DataFrame:
    """Read what has landed since the last run, apply `work`, append it to `target`, and return the whole target.

    `state` keeps which files were read, and with `keys` which keys were seen, so rows of a key that came in an earlier
    run are passed over. With `late` (a time column and a delay) a key is remembered for that long only, so the state stays
    bounded; without it keys are remembered for ever. The run ends when nothing new is there.
    """
    reader = spark.readStream.format("parquet").schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    stream = reader.load(source)
    stream = work(stream) if work else stream
    if keys:
        stream = stream.withColumn(late[0], F.col(late[0]).cast("timestamp")) if late else stream
        stream = stream.withWatermark(*late).dropDuplicatesWithinWatermark(keys) if late else stream.dropDuplicates(keys)
    query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", state).trigger(availableNow=True).start(target)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def windowed_totals(events: DataFrame, time: str, late: str, window: str, keys: list[str], value: str) -> DataFrame:
    """Events and their values by window and key; on a stream, windows close once the watermark has passed them."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count("*").alias("events"), F.sum(value).alias("total"))


def log_run(spark: SparkSession, runs: str, source: str, status: str, rows: int) -> None:
    """Append a line to the run log."""
    row = spark.createDataFrame([(source, status, rows)], "source string, status string, rows long").withColumn("ended", F.current_timestamp())
    row.coalesce(1).write.mode("append").parquet(runs)


def run_totals(runs: DataFrame) -> DataFrame:
    """Rows by source and, with a null source, over all; success only if every run succeeded."""
    return runs.rollup("source").agg(F.sum("rows").alias("rows"), F.bool_and(F.col("status") == "success").alias("success"))
