"""Registered queries: record batching."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rivulet.operators import batching as B
from rivulet.plans.inputs import RECORDS, records
from rivulet.plans.registry import query

_N = f"""{RECORDS},
n AS (SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS n FROM records),
b AS (SELECT *, n - (n - 1) % 100 AS batch_start FROM n)"""
_BY = 'topic, "partition", batch_start'
_GROUP = f"GROUP BY {_BY}"


def _shown(df, *more):
    return df.select("topic", "partition", "batch_start", *more)


def _text(name):
    return F.col(name).cast("string").alias(name)


@query("batch_count", f"""WITH {_N}
SELECT {_BY}, count(*) AS message_count, CAST(sum(strlen(key) + strlen(value)) AS BIGINT) AS total_bytes FROM b {_GROUP}""")
def batch_count(spark, sf):
    return _shown(B.batch(records(spark, sf)), "message_count", "total_bytes")


@query("batch_key_change", f"""WITH {RECORDS},
k AS (SELECT *, floor(value / 100) AS bucket FROM (SELECT * REPLACE (number AS value) FROM records)),
p AS (SELECT *, row_number() OVER w AS n, coalesce(lag(bucket) OVER w <> bucket, true) AS begins
      FROM k WINDOW w AS (PARTITION BY topic, "partition" ORDER BY "offset")),
r AS (SELECT *, max(CASE WHEN begins THEN n END) OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS run FROM p)
SELECT topic, "partition", n - (n - run) % 3 AS batch_start, CAST(CAST(any_value(bucket) AS BIGINT) AS VARCHAR) AS key, count(*) AS message_count
FROM r GROUP BY 1, 2, 3""")
def batch_key_change(spark, sf):
    rows = records(spark, sf)
    amount = F.get_json_object(F.col("value").cast("string"), "$.value").cast("double")
    keyed = rows.withColumn("key", F.floor(amount / 100).cast("string").cast("binary"))
    return _shown(B.batch(keyed, flush_on_key_change=True, max_messages=3), _text("key"), "message_count")


@query("batch_bytes", f"""WITH RECURSIVE {RECORDS},
n AS (SELECT topic, "partition", "offset", strlen(key) + strlen(value) AS size,
      row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS n FROM records),
walk AS (SELECT topic, "partition", n, size, size AS filled, n AS batch_start FROM n WHERE n = 1
  UNION ALL SELECT n.topic, n."partition", n.n, n.size,
    CASE WHEN w.filled + n.size > 2000 OR n.n - w.batch_start >= 40 THEN n.size ELSE w.filled + n.size END,
    CASE WHEN w.filled + n.size > 2000 OR n.n - w.batch_start >= 40 THEN n.n ELSE w.batch_start END
  FROM walk w JOIN n ON n.topic = w.topic AND n."partition" = w."partition" AND n.n = w.n + 1)
SELECT topic, "partition", batch_start, count(*) AS message_count, CAST(sum(size) AS BIGINT) AS total_bytes FROM walk GROUP BY 1, 2, 3""")
def batch_bytes(spark, sf):
    return _shown(B.batch(records(spark, sf), max_messages=40, max_bytes=2000), "message_count", "total_bytes")


@query("batch_timeout", f"""WITH RECURSIVE {RECORDS},
n AS (SELECT topic, "partition", epoch_us("timestamp") AS t,
      row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS n FROM records),
c AS (SELECT topic, "partition", n, max(t) OVER (PARTITION BY topic, "partition" ORDER BY n) AS t FROM n),
walk AS (SELECT topic, "partition", n, t AS opened, n AS batch_start FROM c WHERE n = 1
  UNION ALL SELECT c.topic, c."partition", c.n,
    CASE WHEN c.t - w.opened >= 28800000000 OR c.n - w.batch_start >= 10 THEN c.t ELSE w.opened END,
    CASE WHEN c.t - w.opened >= 28800000000 OR c.n - w.batch_start >= 10 THEN c.n ELSE w.batch_start END
  FROM walk w JOIN c ON c.topic = w.topic AND c."partition" = w."partition" AND c.n = w.n + 1)
SELECT topic, "partition", batch_start, count(*) AS message_count FROM walk GROUP BY 1, 2, 3""")
def batch_timeout(spark, sf):
    return _shown(B.batch(records(spark, sf), max_messages=10, max_age="8 hours"), "message_count")


@query("batch_json_array", f"""WITH {_N}
SELECT {_BY}, '[' || string_agg(CASE WHEN number < 20 THEN '"' || to_base64(CAST(event_type AS BLOB)) || '"' ELSE value END, ',' ORDER BY "offset") || ']' AS value
FROM b {_GROUP}""")
def batch_json_array(spark, sf):
    rows = records(spark, sf)
    amount = F.get_json_object(F.col("value").cast("string"), "$.value").cast("double")
    mixed = rows.withColumn("value", F.when(amount < 20, F.col("topic").cast("binary")).otherwise(F.col("value")))
    return _shown(B.batch(mixed), _text("value"))


@query("batch_json_lines", f"""WITH {_N}
SELECT {_BY}, string_agg(value, chr(10) ORDER BY "offset") AS value FROM b {_GROUP}""")
def batch_json_lines(spark, sf):
    return _shown(B.batch(records(spark, sf), "json-lines"), _text("value"))


@query("batch_raw", f"""WITH {_N}
SELECT {_BY}, string_agg(value, '|' ORDER BY "offset") AS value FROM b {_GROUP}""")
def batch_raw(spark, sf):
    return _shown(B.batch(records(spark, sf), "raw", separator="|"), _text("value"))


@query("batch_key", f"""WITH {_N}
SELECT {_BY}, min_by(key, "offset") AS first, max_by(key, "offset") AS last, string_agg(key, ';' ORDER BY "offset") AS joined
FROM b {_GROUP}""")
def batch_key(spark, sf):
    batched = B.assign_batches(records(spark, sf))
    out = None
    for strategy, name in (("first", "first"), ("last", "last"), ("concat", "joined")):
        packed = B.pack(batched, "raw", strategy, ";").select("topic", "partition", "batch_start", F.col("key").cast("string").alias(name))
        out = packed if out is None else out.join(packed, ["topic", "partition", "batch_start"])
    return out


@query("batch_metadata", f"""WITH {_N}
SELECT {_BY}, '[' || string_agg('{{"topic":"' || topic || '","partition":' || "partition" || ',"offset":' || "offset" || ',"key":"' ||
  to_base64(CAST(key AS BLOB)) || '","value":' || value || ',"timestamp":"' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || '0+00:00"}}', ',' ORDER BY "offset") || ']' AS value
FROM b {_GROUP}""")
def batch_metadata(spark, sf):
    return _shown(B.batch(records(spark, sf), include_metadata=True), _text("value"))


@query("batch_gzip", f"""WITH {_N}
SELECT {_BY}, count(*) AS message_count, true AS compressed, md5(string_agg(value, chr(10) ORDER BY "offset")) AS digest FROM b {_GROUP}""")
def batch_gzip(spark, sf):
    packed = B.batch(records(spark, sf), "json-lines", compression="gzip")
    return _shown(packed, "message_count", "compressed", unzipped_md5("value").alias("digest"))


@F.pandas_udf(StringType())
def unzipped_md5(data):
    import gzip
    import hashlib

    return data.map(lambda d: hashlib.md5(gzip.decompress(bytes(d))).hexdigest())
