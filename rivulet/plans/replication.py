"""Registered queries: replication bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import replication as M
from rivulet.plans.inputs import RECORDS, plain, records, table
from rivulet.plans.registry import query

# Topics derived from the events: plain, already prefixed, looping, internal.
_NAMES = """names AS (SELECT event_id, CASE WHEN value < 5 THEN '__' || event_type WHEN value < 10 THEN 'dc1.' || event_type || '.heartbeats'
  WHEN value < 15 THEN event_type || '.checkpoints.internal' WHEN value < 40 THEN 'dc2.' || event_type
  WHEN value < 60 THEN 'dc3.dc2.' || event_type WHEN value < 70 THEN 'a.__b.' || event_type ELSE event_type END AS topic FROM events)"""


def _names(spark, sf):
    kind, value = F.col("event_type"), F.col("value")
    topic = (
        F.when(value < 5, F.concat(F.lit("__"), kind)).when(value < 10, F.concat(F.lit("dc1."), kind, F.lit(".heartbeats")))
        .when(value < 15, F.concat(kind, F.lit(".checkpoints.internal"))).when(value < 40, F.concat(F.lit("dc2."), kind))
        .when(value < 60, F.concat(F.lit("dc3.dc2."), kind)).when(value < 70, F.concat(F.lit("a.__b."), kind)).otherwise(kind)
    )
    return table(spark, sf, "events").select("event_id", topic.alias("topic"))


@query("topic_select", f"""WITH {_NAMES} SELECT topic, event_id FROM names
WHERE NOT starts_with(topic, '__') AND NOT ends_with(topic, '.heartbeats') AND NOT ends_with(topic, '.checkpoints.internal')
  AND topic <> 'view' AND regexp_matches(topic, 'click|error|view')""")
def topic_select(spark, sf):
    return M.select_topics(_names(spark, sf), deny=["view"], pattern="click|error|view").select("topic", "event_id")


@query("group_select", """SELECT "group", event_id FROM (SELECT event_id, CASE WHEN value < 30 THEN 'connect-' || event_type
  WHEN value < 50 THEN 'mirror-maker-2' ELSE event_type || '-' || user_id END AS "group" FROM events)
WHERE NOT starts_with("group", 'connect-') AND NOT starts_with("group", 'mirror-maker-') AND "group" <> 'click-1'""")
def group_select(spark, sf):
    group = (
        F.when(F.col("value") < 30, F.concat(F.lit("connect-"), "event_type")).when(F.col("value") < 50, "mirror-maker-2")
        .otherwise(F.concat_ws("-", "event_type", "user_id"))
    )
    return M.select_groups(table(spark, sf, "events").select("event_id", group.alias("group")), deny=["click-1"])


@query("remote_topic", f"""WITH {_NAMES}, i AS (SELECT *, starts_with(topic, '__') OR ends_with(topic, '.heartbeats') OR
  ends_with(topic, '.checkpoints.internal') AS internal, string_split(topic, '.') AS parts FROM names)
SELECT event_id, CASE WHEN internal OR len(parts) = 1 THEN 'dc1.' || topic ELSE topic END AS remote,
  CASE WHEN internal OR len(parts) = 1 THEN topic ELSE substr(topic, len(parts[1]) + 2) END AS original,
  CASE WHEN internal THEN '' WHEN parts[2] = '__b' THEN 'a' ELSE array_to_string(parts[:-2], '>') END AS upstream,
  starts_with(topic, 'dc2.') AS loop FROM i""")
def remote_topic(spark, sf):
    out = M.remote_topic(_names(spark, sf), "dc1", "dc2")
    return out.select("event_id", "remote", "original", F.array_join("upstream", ">").alias("upstream"), "loop")


@query("replicate", f"""WITH {RECORDS}, {_NAMES}
SELECT CASE WHEN starts_with(n.topic, 'dc3.') OR starts_with(n.topic, 'a.') THEN n.topic ELSE 'dc1.' || n.topic END AS topic,
  "partition", "offset", key, value FROM records JOIN names n USING (event_id)
WHERE NOT starts_with(n.topic, '__') AND NOT ends_with(n.topic, '.heartbeats') AND NOT ends_with(n.topic, '.checkpoints.internal')
  AND NOT starts_with(n.topic, 'dc2.')""")
def replicate(spark, sf):
    named = _names(spark, sf).select(F.col("event_id").alias("offset"), "topic")
    rows = records(spark, sf).drop("topic").join(named, "offset")
    return plain(M.replicate(rows, "dc1", "dc2"))


def _mappings(spark, sf):
    """Sync points: events with a small `k`, sharded by event type; views have none."""
    small = F.get_json_object("props", "$.k").cast("int") < 10
    events = table(spark, sf, "events").where((F.col("event_type") != "view") & small)
    return events.select(
        F.lit("dc1").alias("cluster"), F.col("event_type").alias("topic"), (F.col("user_id") % 2).cast("int").alias("partition"),
        F.col("event_id").alias("source_offset"), (F.col("event_id") - F.floor(F.col("event_id") / 20)).alias("target_offset"))


def _commits(spark, sf):
    return table(spark, sf, "events").select(
        F.concat(F.lit("g"), F.col("user_id") % 7).alias("group"), F.lit("dc1").alias("cluster"),
        F.col("event_type").alias("topic"), (F.col("user_id") % 2).cast("int").alias("partition"),
        (F.col("event_id") - 3).alias("offset"), F.col("ts").alias("timestamp"))


_MAPPED = """m AS (SELECT event_type AS topic, CAST(user_id % 2 AS INTEGER) AS "partition", event_id AS source, event_id - event_id // 20 AS target
  FROM events WHERE event_type <> 'view' AND CAST(json_extract_string(props, '$.k') AS INTEGER) < 10),
commits AS (SELECT 'g' || user_id % 7 AS "group", event_type AS topic, CAST(user_id % 2 AS INTEGER) AS "partition", event_id - 3 AS "offset", ts FROM events),
lo AS (SELECT c.*, m.source AS ls, m.target AS lt FROM commits c ASOF LEFT JOIN m
  ON c.topic = m.topic AND c."partition" = m."partition" AND c."offset" >= m.source),
hi AS (SELECT lo.*, m.source AS us, m.target AS ut FROM lo ASOF LEFT JOIN m
  ON lo.topic = m.topic AND lo."partition" = m."partition" AND lo."offset" <= m.source),
moved AS (SELECT *, CASE WHEN ls = "offset" THEN lt WHEN ls IS NULL THEN ut WHEN us IS NULL THEN lt + ("offset" - ls)
  ELSE lt + CAST(trunc((CAST("offset" - ls AS DOUBLE) / (us - ls)) * (ut - lt)) AS BIGINT) END AS target_offset FROM hi)"""


@query("offset_translate", f"""WITH {_MAPPED} SELECT "group", topic, "partition", "offset", target_offset FROM moved""")
def offset_translate(spark, sf):
    out = M.translate(_commits(spark, sf), _mappings(spark, sf))
    return out.select("group", "topic", "partition", "offset", "target_offset")


@query("checkpoints", f"""WITH {_MAPPED}
SELECT "group", topic, "partition", "offset" AS source_offset, coalesce(target_offset, "offset") AS target_offset FROM moved
WHERE "offset" >= 0 AND "group" <> 'g3'
QUALIFY row_number() OVER (PARTITION BY "group", topic, "partition" ORDER BY ts DESC, "offset" DESC) = 1""")
def checkpoints(spark, sf):
    out = M.checkpoints(_commits(spark, sf), _mappings(spark, sf), deny=["g3"])
    return out.select("group", "topic", "partition", "source_offset", "target_offset")


@query("consumer_lag", f"""WITH {_MAPPED}, ends AS (SELECT event_type AS topic, CAST(user_id % 2 AS INTEGER) AS "partition", max(event_id) AS e
  FROM events GROUP BY 1, 2)
SELECT "group", topic, "partition", max("offset") AS committed, min(e - "offset") AS lag FROM commits JOIN ends USING (topic, "partition")
GROUP BY 1, 2, 3""")
def consumer_lag(spark, sf):
    ends = table(spark, sf, "events").groupBy(
        F.col("event_type").alias("topic"), (F.col("user_id") % 2).cast("int").alias("partition")
    ).agg(F.max("event_id").alias("end_offset"))
    last = _commits(spark, sf).groupBy("group", "topic", "partition").agg(F.max("offset").alias("offset"))
    return M.lag(ends, last).select("group", "topic", "partition", F.col("offset").alias("committed"), "lag")


@query("heartbeats", """WITH h AS (SELECT event_type AS source_cluster, 'hub' AS target_cluster, epoch_us(ts) // 1000 AS t,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS late FROM events)
SELECT source_cluster, target_cluster, t AS "timestamp", t - lag(t) OVER (PARTITION BY source_cluster ORDER BY t) AS gap_ms,
  late AS latency_ms FROM h""")
def heartbeats(spark, sf):
    sent = F.unix_millis(F.col("ts").cast("timestamp"))
    beats = table(spark, sf, "events").select(
        F.col("event_type").alias("source_cluster"), F.lit("hub").alias("target_cluster"), sent.alias("timestamp"),
        (sent + F.get_json_object("props", "$.k").cast("long")).alias("received"))
    return M.heartbeat_gaps(beats, received="received").select("source_cluster", "target_cluster", "timestamp", "gap_ms", "latency_ms")
