"""Queries of incremental operators: streams that read the given tables must give what batches give."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.plans.registry import registry
from terraloom.session import read, shared_dir
from terraloom.streaming import ingest

QUERIES, ORACLES, query = registry()


def _streamed(spark: SparkSession, sf_dir: str, keys: list[str] | None = None) -> DataFrame:
    base = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex[:12]}"
    schema = read(spark, sf_dir, "events").schema
    # The table is a file or a folder of files; a glob finds it either way.
    source = f"{sf_dir}/[e]vents.parquet"
    return ingest.ingest(spark, source, schema, f"{base}/target", f"{base}/state", keys=keys)


@query("SELECT event_type, count(*) AS events, round(sum(value), 2) AS total FROM events GROUP BY 1")
def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("events"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT count(DISTINCT (user_id, event_type)) AS pairs FROM events")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys once each, by the stream's state."""
    return _streamed(spark, sf_dir, ["user_id", "event_type"]).agg(F.count("*").alias("pairs"))


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS events, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def windowed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ingest.windowed_totals(read(spark, sf_dir, "events"), "ts", "1 day", "1 day", ["event_type"], "value")
    return out.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "events", F.round("total", 2).alias("total"))


@query("""
    SELECT source, CAST(sum(n) AS BIGINT) AS rows, bool_and(ok) AS success FROM (
      SELECT event_type AS source, count(*) AS n, count(*) FILTER (value < 0) = 0 AS ok FROM events GROUP BY 1) GROUP BY ROLLUP (source)""")
def run_log_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source")).agg(F.count("*").alias("rows"), F.when(F.count_if(F.col("value") < 0) == 0, "success").otherwise("failed").alias("status"))
    return ingest.run_totals(runs)
