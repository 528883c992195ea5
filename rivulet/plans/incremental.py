"""Registered queries: incremental reads, pages and ranges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from rivulet.plans.inputs import RECORDS, plain, records, table
from rivulet.plans.registry import query
from rivulet.sources import incremental as I

_ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"
_COLS = [c.strip() for c in _ORDER.split(",")]
_SINCE = datetime(1996, 6, 1)


def _orders(spark, sf):
    return table(spark, sf, "orders").select(*_COLS)


@query("incr_bulk", f"SELECT {_ORDER} FROM orders")
def incr_bulk(spark, sf):
    return I.incremental(_orders(spark, sf), "bulk")


@query("incr_id", f"SELECT {_ORDER} FROM orders WHERE o_orderkey > 500")
def incr_id(spark, sf):
    return I.incremental(_orders(spark, sf), "incrementing", id_col="o_orderkey", last_id=500)


@query("incr_ts", f"SELECT {_ORDER} FROM orders WHERE o_orderdate > TIMESTAMP '1996-06-01'")
def incr_ts(spark, sf):
    return I.incremental(_orders(spark, sf), "timestamp", ts_col="o_orderdate", last=_SINCE)


@query("incr_ts_id", f"""SELECT {_ORDER} FROM orders WHERE o_orderdate > TIMESTAMP '1996-06-01'
   OR (o_orderdate = TIMESTAMP '1996-06-01' AND o_orderkey > 700)""")
def incr_ts_id(spark, sf):
    return I.incremental(_orders(spark, sf), ts_col="o_orderdate", id_col="o_orderkey", last=_SINCE, last_id=700)


@query("incr_seen", f"""SELECT {_ORDER} FROM orders WHERE o_orderdate >= TIMESTAMP '1996-06-01'
   AND NOT (o_orderdate = TIMESTAMP '1996-06-01' AND o_orderstatus = 'F')""")
def incr_seen(spark, sf):
    orders = _orders(spark, sf)
    seen = orders.where((F.col("o_orderdate") == F.lit(_SINCE)) & (F.col("o_orderstatus") == "F"))
    return I.incremental(orders, "inclusive", ts_col="o_orderdate", id_col="o_orderkey", last=_SINCE, seen=seen)


@query("incr_composite", """SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem
WHERE l_suppkey > 5 OR (l_suppkey = 5 AND l_partkey > 100) GROUP BY ALL""")
def incr_composite(spark, sf):
    rows = I.incremental(table(spark, sf, "lineitem"), "keyset", cols=["l_suppkey", "l_partkey"], last=[5, 100])
    return rows.groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))


@query("keyset_page", f"""SELECT {_ORDER} FROM orders
WHERE o_orderdate > TIMESTAMP '1996-06-01' OR (o_orderdate = TIMESTAMP '1996-06-01' AND o_orderkey > 700)
ORDER BY o_orderdate, o_orderkey LIMIT 500""")
def keyset_page(spark, sf):
    return I.page(_orders(spark, sf), ["o_orderdate", "o_orderkey"], [_SINCE, 700], 500)


_MARKS = """marks AS (SELECT event_type, min(ts) + INTERVAL 10 DAY AS mark FROM events WHERE event_type <> 'view' GROUP BY 1)"""


@query("incr_per_group", f"""WITH {_MARKS},
rows AS (SELECT e.* FROM events e LEFT JOIN marks m USING (event_type) WHERE e.ts > coalesce(m.mark, TIMESTAMP '2024-01-05'))
SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids, max(ts) AS mark FROM rows GROUP BY 1""")
def incr_per_group(spark, sf):
    events = table(spark, sf, "events")
    marks = events.where("event_type <> 'view'").groupBy("event_type").agg(
        (F.min("ts") + F.expr("interval 10 days")).alias("mark"))
    rows = I.incremental(events, "timestamp", ts_col="ts", group_col="event_type", marks=marks, default=datetime(2024, 1, 5))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.max("ts").alias("mark"))


@query("incr_query", """SELECT o_custkey, day, spent FROM (
  SELECT o_custkey, max(o_orderdate) AS day, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1)
WHERE day > TIMESTAMP '1998-01-01' OR (day = TIMESTAMP '1998-01-01' AND o_custkey > 10)""")
def incr_query(spark, sf):
    wrapped = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("day"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return I.incremental(wrapped, ts_col="day", id_col="o_custkey", last=datetime(1998, 1, 1), last_id=10)


@query("rowkey_range", f"""WITH cells AS (
  SELECT 'u' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS row_key, event_type AS "column", event_id AS ts,
         CAST(value AS VARCHAR) AS value FROM events)
SELECT row_key, 'ev' AS family, "column", max_by(value, ts) AS value, max(ts) AS ts FROM cells
WHERE row_key > 'u000010' AND row_key < 'u9' AND "column" <> 'error' GROUP BY row_key, "column\"""")
def rowkey_range(spark, sf):
    cells = table(spark, sf, "events").select(
        F.concat(F.lit("u"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("row_key"),
        F.lit("ev").alias("family"), F.col("event_type").alias("column"),
        F.col("event_id").alias("ts"), F.col("value").cast("string").alias("value"))
    return I.rowkey_scan(cells, start="u000000", end="u9", resume_after="u000010", families=["ev"],
                         columns=["click", "view", "purchase", "signup"])


@query("select_expand", """SELECT o_orderkey, o_totalprice, c_name AS customer, n_name AS nation, r_name AS region
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey WHERE o_totalprice >= 1000""")
def select_expand(spark, sf):
    nations = I.odata(table(spark, sf, "nation"), expand={"region": (table(spark, sf, "region"), ("n_regionkey", "r_regionkey"))})
    customers = I.odata(table(spark, sf, "customer"), expand={"nation": (nations, ("c_nationkey", "n_nationkey"))})
    out = I.odata(table(spark, sf, "orders"), ["o_orderkey", "o_totalprice"], filter="o_totalprice >= 1000",
                  expand={"customer": (customers, ("o_custkey", "c_custkey"))})
    return out.select("o_orderkey", "o_totalprice", F.col("customer.c_name").alias("customer"),
                      F.col("customer.nation.n_name").alias("nation"), F.col("customer.nation.region.r_name").alias("region"))


@query("predicate_query", f"SELECT {_ORDER} FROM orders WHERE o_totalprice >= 250000.5 ORDER BY o_orderkey DESC LIMIT 300")
def predicate_query(spark, sf):
    return I.query(_orders(spark, sf), "o_totalprice:gte:250000.5", "o_orderkey", descending=True, limit=300)


@query("recent_n", f"""WITH {RECORDS}
SELECT topic, "partition", "offset", key, value FROM records
QUALIFY row_number() OVER (PARTITION BY topic ORDER BY "offset" DESC) <= 100""")
def recent_n(spark, sf):
    return plain(I.recent(records(spark, sf), 100))
