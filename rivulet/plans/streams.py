"""Registered queries: Structured Streaming over files written from the given tables.

The events arrive in parts. After each part the query runs until nothing is
left, stops, and goes on from its checkpoint with the next part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import aggregation as A, keyed as K
from rivulet.plans.aggregates import SESSIONS
from rivulet.plans.inputs import RECORDS, plain, records, scratch, table
from rivulet.plans.registry import query
from rivulet.sinks.tables import BucketedTable, VersionedTable
from rivulet.sources import files as I
from rivulet.streaming import queries as Q


def _replayed(spark, sf, run, arrivals=3):
    """Call `run(stream, folder)` after each arrival of the next range of offsets; returns the folder."""
    folder = scratch(spark)
    rows = records(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    width = rows.agg(F.max("offset")).first()[0] // arrivals + 1
    for i in range(arrivals):
        arrived = rows.where(F.col("offset").between(i * width, (i + 1) * width - 1))
        arrived.write.mode("append").parquet(f"{folder}/in")
        run(I.stream_files(spark, "parquet", f"{folder}/in", rows.schema), folder)
    return folder


def _appended(spark, sf, build):
    """The rows a streaming frame has appended after all arrivals."""
    folder = _replayed(spark, sf, lambda stream, at: Q.run_available(build(stream), f"{at}/out", f"{at}/checkpoint"))
    return spark.read.parquet(f"{folder}/out")


@query("file_stream", f'WITH {RECORDS} SELECT topic, "offset", key, value FROM records')
def file_stream(spark, sf):
    return plain(_appended(spark, sf, lambda stream: stream), "topic", "offset", "key", "value")


@query("text_tail", """SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line""")
def text_tail(spark, sf):
    folder = scratch(spark)
    table(spark, sf, "documents").select(F.regexp_replace("text", "\n", "\r\n").alias("value")).write.text(f"{folder}/in")
    Q.run_available(I.stream_lines(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query("stream_window", """WITH w AS (SELECT event_type AS "group", time_bucket(INTERVAL 1 HOUR, ts) AS start, round(sum(value), 4) AS result, count(*) AS count
  FROM events GROUP BY 1, 2)
SELECT "group", 'sum' AS operation, result, count, start + INTERVAL 1 HOUR AS window_end FROM w
WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def stream_window(spark, sf):
    out = _appended(spark, sf, lambda stream: A.aggregate(stream, "sum", "value", "type", window="1 hour", watermark="10 minutes"))
    return out.withColumns({"result": F.round("result", 4), "window_end": F.col("window_end").cast("timestamp_ntz")})


@query("stream_sessions", f"""{SESSIONS} WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def stream_sessions(spark, sf):
    """Sessions that the watermark has closed."""
    out = _appended(spark, sf, lambda stream: A.aggregate(stream, "sum", "value", "type", session="4 minutes", watermark="10 minutes"))
    return out.withColumns({"result": F.round("result", 4), **{c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}})


@query("stream_dedupe", f'WITH {RECORDS} SELECT topic, "partition", "offset" FROM records')
def stream_dedupe(spark, sf):
    def build(stream):
        twice = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
        return K.dedupe(twice, ["topic", "partition", "offset"], watermark=("timestamp", "1 hour"))

    return _appended(spark, sf, build).select("topic", "partition", "offset")


@query("stream_state_change", """SELECT user_id, event_id, event_type FROM events
QUALIFY lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) IS DISTINCT FROM event_type""")
def stream_state_change(spark, sf):
    def build(stream):
        watched = stream.select(F.col("key").cast("string").cast("long").alias("user_id"),
                                F.col("offset").alias("event_id"), F.col("topic").alias("event_type"))
        return Q.on_change_stream(watched, ["user_id"], "event_id", ["event_type"])

    return _appended(spark, sf, build)


@query("stream_upsert", f"""WITH {RECORDS}
SELECT key, max_by(topic, "offset") AS topic, max("offset") AS "offset" FROM records GROUP BY key""")
def stream_upsert(spark, sf):
    def run(stream, folder):
        updates = stream.select(F.col("key").cast("string").alias("key"), "topic", "offset")
        Q.apply_stream(updates, f"{folder}/table", "upsert", ["key"], ["offset"], updates.schema, f"{folder}/checkpoint")

    return VersionedTable(spark, f"{_replayed(spark, sf, run)}/table").read()


@query("stream_batches", f"""WITH RECURSIVE {RECORDS},
n AS (SELECT topic, "partition", "offset", key, value, strlen(key) + strlen(value) AS size, floor(number / 400) AS bucket,
      row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS n FROM (SELECT * REPLACE (floor(number / 400)::INT::VARCHAR AS key) FROM records)),
walk AS (SELECT topic, "partition", n, size AS filled, bucket, 1 AS held, n AS batch FROM n WHERE n = 1
  UNION ALL SELECT n.topic, n."partition", n.n,
    CASE WHEN w.held >= 9 OR w.filled + n.size > 700 OR n.bucket <> w.bucket THEN n.size ELSE w.filled + n.size END, n.bucket,
    CASE WHEN w.held >= 9 OR w.filled + n.size > 700 OR n.bucket <> w.bucket THEN 1 ELSE w.held + 1 END,
    CASE WHEN w.held >= 9 OR w.filled + n.size > 700 OR n.bucket <> w.bucket THEN n.n ELSE w.batch END
  FROM walk w JOIN n ON n.topic = w.topic AND n."partition" = w."partition" AND n.n = w.n + 1),
b AS (SELECT n.topic, n."partition", batch, min("offset") AS first_offset, any_value(key) AS key, string_agg(value, chr(10) ORDER BY "offset") AS value,
  count(*) AS message_count, CAST(sum(size) AS BIGINT) AS total_bytes FROM walk JOIN n USING (topic, "partition", n) GROUP BY 1, 2, 3)
SELECT topic, "partition", first_offset, key, md5(value) AS digest, message_count, total_bytes FROM b
QUALIFY message_count = 9 OR batch < max(batch) OVER (PARTITION BY topic, "partition")""")
def stream_batches(spark, sf):
    """The batches that have closed; each partition's last one waits for more records."""
    def build(stream):
        amount = F.get_json_object(F.col("value").cast("string"), "$.value").cast("double")
        keyed = stream.withColumn("key", F.floor(amount / 400).cast("string").cast("binary"))
        return Q.stream_batches(keyed, "json-lines", max_messages=9, max_bytes=700, flush_on_key_change=True)

    out = _appended(spark, sf, build)
    return out.select("topic", "partition", "first_offset", F.col("key").cast("string").alias("key"),
                      F.md5("value").alias("digest"), "message_count", "total_bytes")


@query("stream_bucketed", f"""WITH {RECORDS}
SELECT key, max_by(topic, "offset") AS topic, max("offset") AS "offset" FROM records GROUP BY key""")
def stream_bucketed(spark, sf):
    schema = "key string, topic string, offset long"

    def run(stream, folder):
        updates = stream.select(F.col("key").cast("string").alias("key"), "topic", "offset")
        Q.apply_stream(updates, f"{folder}/table", "upsert", ["key"], ["offset"], updates.schema, f"{folder}/checkpoint", buckets=8)

    table = f"{_replayed(spark, sf, run)}/table"
    return BucketedTable(spark, table, ["key"], spark.createDataFrame([], schema).schema, 8).read()
