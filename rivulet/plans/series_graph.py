"""Registered queries: time series and graphs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from rivulet.operators import graph as G, points as P
from rivulet.plans.inputs import table
from rivulet.plans.registry import query


def _points(spark, sf):
    events = table(spark, sf, "events").withColumn("missing", F.lit(None).cast("string"))
    return P.to_points(events, "clicks", "event_type", tags=["user_id", "missing"], fields=["event_id", "value", "props"], ts_col="ts")


_POINTS = """points AS (
  SELECT event_type AS measurement, CAST(user_id AS VARCHAR) AS tag, 'event_id' AS field, event_id AS long_value,
         CAST(NULL AS DOUBLE) AS double_value, CAST(NULL AS VARCHAR) AS string_value, ts FROM events
  UNION ALL SELECT event_type, CAST(user_id AS VARCHAR), 'value', NULL, value, NULL, ts FROM events
  UNION ALL SELECT event_type, CAST(user_id AS VARCHAR), 'props', NULL, NULL, props, ts FROM events)"""


@query("points_from_rows", f"WITH {_POINTS} SELECT *, 1 AS tags FROM points")
def points_from_rows(spark, sf):
    return _points(spark, sf).select("measurement", F.col("tags")["user_id"].alias("tag"), "field", "long_value",
                                     "double_value", "string_value", "ts", F.size("tags").alias("tags"))


@query("points_timestamp", """SELECT event_id, date_trunc('second', ts) AS s, date_trunc('millisecond', ts) AS ms, ts AS us, ts AS ns,
 ts AS iso, ts - INTERVAL 2 HOUR AS zoned, date_trunc('day', ts)::TIMESTAMP AS day FROM events""")
def points_timestamp(spark, sf):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    columns = {
        "s": P.parse_ts(F.floor(micros / 1000000), "s", numeric=True),
        "ms": P.parse_ts(F.floor(micros / 1000), "ms", numeric=True),
        "us": P.parse_ts(micros, "us", numeric=True),
        "ns": P.parse_ts(micros * 1000 + 999, "ns", numeric=True),
        "iso": P.parse_ts(text),
        "zoned": P.parse_ts(F.concat(text, F.lit("+02:00"))),
        "day": P.parse_ts(F.date_format("ts", "yyyy-MM-dd")),
    }
    out = table(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in columns.items()])
    return out.select("event_id", *[F.col(n).cast("timestamp_ntz").alias(n) for n in columns])


@query("points_range", f"""WITH {_POINTS}
SELECT measurement, tag, field, long_value, double_value, string_value, ts FROM points
WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-27' AND measurement = 'click'
QUALIFY row_number() OVER (PARTITION BY measurement, tag, field ORDER BY ts) <= 5""")
def points_range(spark, sf):
    out = P.range_points(_points(spark, sf), datetime(2024, 1, 3), datetime(2024, 1, 27), measurement="click", n=5)
    return out.select("measurement", F.col("tags")["user_id"].alias("tag"), "field", "long_value", "double_value", "string_value", "ts")


@query("series_key", """SELECT 'orders:' || o_orderpriority || ':' || o_orderstatus AS series, count(*) AS n,
  round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def series_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")
    points = P.to_points(orders, "orders", tags=["o_orderstatus", "o_orderpriority"], ts_col="o_orderdate")
    keyed = points.withColumn("series", P.series_key(F.col("measurement"), F.col("tags")))
    return keyed.groupBy("series").agg(F.count("*").alias("n"), F.round(F.sum("double_value"), 2).alias("total"))


def _customers(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return G.nodes_of(customers, "customer", ["c_custkey"], "c_mktsegment")


def _orders(spark, sf):
    """Every order patches its customer's node in the building segment and voids the balance."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("status"),
        F.lit(None).cast("string").alias("c_acctbal"), F.col("o_orderkey").alias("offset"))


_NODES = """nodes AS (
  SELECT coalesce(c.c_mktsegment, 'BUILDING') AS label, CAST(coalesce(c.c_custkey, p.o_custkey) AS VARCHAR) AS id,
    c.c_name AS name, CASE WHEN p.o_custkey IS NULL THEN CAST(c.c_acctbal AS VARCHAR) END AS balance, p.priority, p.status
  FROM customer c FULL JOIN (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS priority,
      nullif(arg_max(o_orderstatus, o_orderkey), 'F') AS status FROM orders GROUP BY 1) p
    ON c.c_custkey = p.o_custkey AND c.c_mktsegment = 'BUILDING')"""


@query("graph_nodes", f"WITH {_NODES} SELECT * FROM nodes")
def graph_nodes(spark, sf):
    out = G.upsert_nodes(_customers(spark, sf), _orders(spark, sf), "BUILDING", ["c_custkey"])
    return out.select("label", "id", F.col("properties")["c_name"].alias("name"), F.col("properties")["c_acctbal"].alias("balance"),
                      F.col("properties")["priority"].alias("priority"), F.col("properties")["status"].alias("status"))


@query("graph_edges", """SELECT 'p' || l_partkey AS "from", 's' || l_suppkey AS "to", 'SUPPLIED' AS label,
  CAST(l_quantity AS VARCHAR) AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE l_returnflag <> 'R' AND p_size > 10 AND s_acctbal > 0""")
def graph_edges(spark, sf):
    parts = table(spark, sf, "part").where("p_size > 10").select(F.concat(F.lit("p"), "p_partkey").alias("id"))
    suppliers = table(spark, sf, "supplier").where("s_acctbal > 0").select(F.concat(F.lit("s"), "s_suppkey").alias("id"))
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.concat(F.lit("p"), "l_partkey")).alias("part"),
        F.concat(F.lit("s"), "l_suppkey").alias("supplier"), F.col("l_quantity").alias("quantity"))
    edges = G.build_edges(lines, "part", "supplier", "SUPPLIED", parts.unionByName(suppliers))
    return edges.select("from", "to", "label", F.col("properties")["quantity"].alias("quantity"))


@query("graph_match", """SELECT o_orderpriority AS label, CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1996-01-01' ORDER BY day, id LIMIT 400""")
def graph_match(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    nodes = G.nodes_of(orders, "order", ["o_orderkey"], "o_orderpriority")
    found = G.match(nodes, "1-URGENT", "day", "1996-01-01", limit=400)
    return found.select("label", "id", F.col("properties")["day"].alias("day"))
