"""Registered queries: projection, predicates and routing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from rivulet.operators import errors as E, routing as R
from rivulet.plans.inputs import RECORDS, plain, records, table
from rivulet.plans.registry import query

_COLS = 'topic, "partition", "offset", key, value'


@query("filter", f"WITH {RECORDS} SELECT {_COLS} FROM records WHERE number > 100")
def filter_(spark, sf):
    return plain(R.filter_records(records(spark, sf), "try_variant_get(json, '$.value', 'double') > 100"))


@query("if_route", f"""WITH {RECORDS}
SELECT CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 THEN 'even' ELSE 'odd' END AS topic,
       "partition", "offset", key, value FROM records""")
def if_route(spark, sf):
    return plain(R.if_route(records(spark, sf), "try_variant_get(json, '$.props.k', 'bigint') % 2 = 0", "even", "odd"))


@query("switch_route", f"""WITH {RECORDS}
SELECT CASE event_type WHEN 'error' THEN 'alerts' WHEN 'purchase' THEN 'sales' WHEN 'signup' THEN 'sales'
       ELSE 'other' END AS topic, "partition", "offset", key, value FROM records""")
def switch_route(spark, sf):
    return plain(R.switch_route(records(spark, sf), "type", "ERROR:alerts, purchase:sales, Signup:sales", "other"))


@query("map", f"""WITH {RECORDS}
SELECT "offset", key, '{{"id":' || event_id || ',"type":"' || upper(event_type) || '"}}' AS value FROM records""")
def map_(spark, sf):
    shaped = F.expr("named_struct('id', try_variant_get(json, '$.event_id', 'bigint'), "
                    "'type', upper(try_variant_get(json, '$.type', 'string')))")
    return plain(R.map_records(records(spark, sf), shaped), "offset", "key", "value")


@query("map_key", f"""WITH {RECORDS}
SELECT "offset", event_type || ':' || key AS key, value FROM records""")
def map_key(spark, sf):
    out = R.map_records(records(spark, sf), "value", "concat(topic, ':', cast(key AS string))")
    return plain(out, "offset", "key", "value")


@query("split", """WITH a AS (SELECT user_id, event_type, min(event_id) AS lo, max(event_id) AS hi, count(*) AS n
  FROM events GROUP BY ALL)
SELECT user_id AS "offset", event_type AS topic, unnest(['{"lo":' || lo || '}', '{"hi":' || hi || '}', '"n"', 'null']) AS value
FROM a""")
def split(spark, sf):
    grouped = table(spark, sf, "events").groupBy("user_id", "event_type").agg(
        F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))
    value = F.concat(F.lit('{"data":{"rows":[{"lo":'), "lo", F.lit('},{"hi":'), "hi", F.lit('},"n",null]}}'))
    framed = grouped.select(F.col("user_id").alias("offset"), F.col("event_type").alias("topic"), value.alias("value"))
    return R.split(framed, "data.rows")


@query("merge", f"""WITH {RECORDS}
SELECT 'all' AS topic, "offset", key, value, event_type AS _source_topic FROM records""")
def merge(spark, sf):
    rows = records(spark, sf)
    named = ["click", "view", "error", "purchase"]
    parts = {t: rows.where(F.col("topic") == t) for t in named}
    parts["signup"] = rows.where(~F.coalesce(F.col("topic").isin(named), F.lit(False)))  # and whatever else there is
    return plain(R.merge(parts, "all", add_source=True), "topic", "offset", "key", "value", "_source_topic")


def _steps(record):
    for step in range(record["offset"] % 3):
        yield {"topic": record["topic"] + f".{step}", "offset": record["offset"], "key": record["key"].decode(),
               "bytes": len(record["value"])}


@query("flat_map_code", f"""WITH {RECORDS}
SELECT topic || '.' || step AS topic, "offset", key, strlen(value) AS bytes
FROM (SELECT *, unnest(range("offset" % 3)) AS step FROM records)""")
def flat_map_code(spark, sf):
    rows = records(spark, sf).select("topic", "offset", "key", "value")
    return R.flat_map(rows, _steps, "topic string, offset long, key string, bytes long")


def _inverse(record):
    left = record["offset"] % 5
    if left == 3:
        raise ValueError("no inverse")
    yield {"offset": record["offset"], "left": left}


@query("dead_letter", f"""WITH {RECORDS}
SELECT "offset", "offset" % 5 AS "left", CAST(NULL AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS error,
       CAST(NULL AS VARCHAR) AS error_type FROM records WHERE "offset" % 5 <> 3
UNION ALL SELECT NULL, NULL, key, 'no inverse', 'ValueError' FROM records WHERE "offset" % 5 = 3""")
def dead_letter(spark, sf):
    rows = records(spark, sf).select("offset", "key")
    out = R.guarded(rows, _inverse, "offset long, left long", "deadletter", carry=["key"])
    return out.select("offset", "left", F.col("original_key").cast("string").alias("key"), "error", "error_type")


@query("error_channel", """SELECT event_id AS "offset", CASE WHEN value < 60 THEN 'dead-letter' WHEN event_type = 'click' THEN 'clicks' ELSE 'others' END AS topic,
  CASE WHEN value < 20 THEN 'not json' WHEN value < 60 THEN '{"n":' || event_id || '}' ELSE event_type END AS value,
  CASE WHEN value < 20 THEN 'payload is not JSON' WHEN value < 60 THEN 'condition cannot be decided' END AS error
FROM events WHERE value < 20 OR event_id % 7 <> 3""")
def error_channel(spark, sf):
    events = table(spark, sf, "events")
    payload = (
        F.when(F.col("value") < 20, "not json")
        .when(F.col("value") < 60, F.concat(F.lit('{"n":'), "event_id", F.lit("}")))
        .otherwise(F.concat(F.lit('{"n":'), "event_id", F.lit(',"type":"'), "event_type", F.lit('"}')))
    )
    rows = events.select(F.lit("in").alias("topic"), F.col("event_id").alias("offset"), payload.cast("binary").alias("value"))
    kept = E.filter_checked(E.checked(rows), F.try_variant_get(F.col("json"), "$.n", "bigint") % 7 != 3)
    kind = F.try_variant_get(F.col("json"), "$.type", "string")
    sent = E.map_checked(E.route_checked(kept, kind == "click", "clicks", "others"), kind)
    return E.settled(sent).select("offset", "topic", F.col("value").cast("string").alias("value"), "error")


@query("topic_map", """SELECT o_orderkey, 'raw.tpch/' || o_orderstatus || '/' || o_orderpriority || '.v1' AS topic FROM orders""")
def topic_map(spark, sf):
    orders = table(spark, sf, "orders")
    named = R.map_topic(orders, "tpch/${o_orderstatus}/${o_orderpriority}", "raw.", ".v1")
    return named.select("o_orderkey", "topic")


@query("render_template", f"""WITH {RECORDS}
SELECT "offset", event_type || ' by u' || user_id || ' (' || key || ') at ' || "offset" || ' []' AS text FROM records""")
def render_template(spark, sf):
    out = R.render(records(spark, sf), "${type} by ${user.name} (${key}) at ${offset} [${value_missing}]")
    return out.select("offset", "text")


@query("project_paths", f"""WITH {RECORDS}
SELECT "offset", user_id AS user_id, number AS amount, event_type AS kind, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM records""")
def project_paths(spark, sf):
    out = R.project_paths(records(spark, sf), {"u": "user.id", "v": "value", "t": "type", "k": "props.k"})
    get = F.try_variant_get
    return out.select("offset", get(F.col("u"), "$", "bigint").alias("user_id"), get(F.col("v"), "$", "double").alias("amount"),
                      get(F.col("t"), "$", "string").alias("kind"), get(F.col("k"), "$", "bigint").alias("k"))


@query("partition_assign", f"""WITH {RECORDS},
b AS (SELECT "offset", key, list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT)) AS codes FROM records)
SELECT "offset", CAST(list_reduce(codes, lambda h, c: (xor(h, c) * 16777619) % 4294967296, CAST(2166136261 AS BIGINT)) % 16 AS INTEGER)
       AS "partition", key AS partition_key FROM b""")
def partition_assign(spark, sf):
    out = R.partition_key(R.assign_partition(records(spark, sf), 16), "missing")
    return out.select("offset", "partition", "partition_key")


@query("keyword_filter", """SELECT conv_id, turn, text AS subject, role AS sender FROM conversations
WHERE contains(lower(text), 'et') AND contains(lower(role), 'assist')
  AND (TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * conv_id) >= TIMESTAMP '2024-01-10' AND length(text) <= 400""")
def keyword_filter(spark, sf):
    mails = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("text").alias("subject"), F.col("role").alias("sender"),
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(conv_id AS int))").alias("date"),
        (F.length("text") > 400).alias("seen"),
    )
    out = R.message_filter(mails, "ET", "Assist", datetime(2024, 1, 10), unseen=True)
    return out.select("conv_id", "turn", "subject", "sender")


@query("payload_project", f"""WITH {RECORDS}
SELECT event_type AS "type", number AS "value", topic AS _topic, "partition" AS _partition, "offset" AS _offset,
       epoch_us("timestamp") // 1000 AS _timestamp, 2 AS members FROM records""")
def payload_project(spark, sf):
    out = R.project_payload(records(spark, sf), ["type", "value", "props"], vector="props")
    return out.select(
        F.try_variant_get(F.col("payload")["type"], "$", "string").alias("type"),
        F.try_variant_get(F.col("payload")["value"], "$", "double").alias("value"),
        "_topic", "_partition", "_offset", "_timestamp", F.size("payload").alias("members"))


_GUID = """lower(substr(h,7,2)||substr(h,5,2)||substr(h,3,2)||substr(h,1,2)||'-'||substr(h,11,2)||substr(h,9,2)||'-'||
       substr(h,15,2)||substr(h,13,2)||'-'||substr(h,17,4)||'-'||substr(h,21,12))"""


@query("stable_id", f"""WITH {RECORDS}, h AS (SELECT *, sha256('u' || user_id) AS h FROM records)
SELECT "offset", {_GUID} AS name_id, CAST(event_id AS VARCHAR) AS number_id FROM h""")
def stable_id(spark, sf):
    named = R.stable_id(records(spark, sf), "field", "user.name", "name_id")
    return R.stable_id(named, "field", "event_id", "number_id").select("offset", "name_id", "number_id")


@query("doc_id", """SELECT o_orderkey, o_custkey || '-' || o_orderstatus AS doc_id FROM orders""")
def doc_id(spark, sf):
    orders = table(spark, sf, "orders").withColumn("nothing", F.lit(None).cast("string"))
    return R.doc_id(orders, "composite", ["o_custkey", "nothing", "o_orderstatus"], "-").select("o_orderkey", "doc_id")


@query("index_route", f"""WITH {RECORDS}
SELECT "offset", topic || '-' || strftime("timestamp", '%Y.%m.%d') AS by_time, event_type AS by_field,
       'logs-' || topic AS by_topic FROM records""")
def index_route(spark, sf):
    out = R.index_name(records(spark, sf), "time", into="by_time")
    out = R.index_name(out, "field", path="type", into="by_field")
    return R.index_name(out, "topic", "logs-${topic}", into="by_topic").select("offset", "by_time", "by_field", "by_topic")
