"""How the given tables enter the operators, and the same frames in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.session import checkpoint_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Scans of this many tasks or more are never dealt out, however many cores there are.
FEW = 64


def spread(rows: DataFrame) -> DataFrame:
    """A text table that arrives in a handful of tasks, dealt out to all cores.

    A row group is one task however heavy the work on its rows, and the other
    splits of its file are empty. Only work on whole texts is worth this; an
    exchange moves fewer than `FEW` splits at most.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= min(cores, FEW) else rows.repartition(cores)


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    rows = table(spark, folder, "documents")
    return spread(rows.select(*columns) if columns else rows)


def records(spark: SparkSession, folder: str) -> DataFrame:
    """`events` as records: the row as a JSON payload, keyed by user."""
    events = table(spark, folder, "events")
    payload = F.concat(
        F.lit('{"event_id":'), F.col("event_id"),
        F.lit(',"user":{"id":'), F.col("user_id"), F.lit(',"name":"u'), F.col("user_id"),
        F.lit('"},"type":"'), F.col("event_type"),
        F.lit('","value":'), F.col("value"),
        F.lit(',"props":'), F.col("props"), F.lit("}"),
    )
    return events.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.col("ts").alias("timestamp"),
        F.create_map().cast("map<string,binary>").alias("headers"),
    )


RECORDS = """records AS (
  SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
         CAST(user_id AS VARCHAR) AS key,
         '{"event_id":' || event_id || ',"user":{"id":' || user_id || ',"name":"u' || user_id ||
         '"},"type":"' || event_type || '","value":' || value || ',"props":' || props || '}' AS value,
         ts AS "timestamp", event_id, user_id, event_type, value AS number, props
  FROM events)"""


def plain(df: DataFrame, *names: str) -> DataFrame:
    """Key and value as text, for comparison."""
    names = names or ("topic", "partition", "offset", "key", "value")
    return df.select(*[F.col(n).cast("string").alias(n) if n in ("key", "value") else F.col(n) for n in names])


def scratch(spark: SparkSession) -> str:
    """A fresh folder every executor can reach."""
    return f"{checkpoint_dir(spark)}/rivulet-{uuid.uuid4().hex}"
