"""Registered queries: change data capture and keyed state."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import cdc as C, keyed as K
from rivulet.plans.inputs import RECORDS, plain, records, table
from rivulet.plans.registry import query

_CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


def _states(spark, sf):
    """Two states of `customer`: debtors vanish, machinery buyers earn interest, households appear."""
    now = table(spark, sf, "customer")
    old = now.where("c_mktsegment <> 'HOUSEHOLD'")
    new = now.where("c_acctbal >= 0").withColumn(
        "c_acctbal", F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return old, new


_STATES = """old AS (SELECT * FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'),
new AS (SELECT * REPLACE (CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal)
        FROM customer WHERE c_acctbal >= 0)"""


@query("cdc_snapshot", """SELECT 'r' AS op, 'sales' AS "schema", 'customer' AS "table", true AS snapshot, CAST(NULL AS BIGINT) AS before_key,
  c_custkey AS after_key, c_name AS after_name, c_acctbal AS after_balance, 1700000000000 AS ts_ms FROM customer""")
def cdc_snapshot(spark, sf):
    events = C.snapshot_events(table(spark, sf, "customer"), "sales", "customer", 1700000000000)
    return events.select("op", "source.schema", "source.table", "source.snapshot",
                         F.col("before.c_custkey").alias("before_key"), F.col("after.c_custkey").alias("after_key"),
                         F.col("after.c_name").alias("after_name"), F.col("after.c_acctbal").alias("after_balance"), "ts_ms")


@query("cdc_events", f"""WITH {_STATES}
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
  CASE WHEN o.c_custkey IS NULL THEN 'c' WHEN n.c_custkey IS NULL THEN 'd' ELSE 'u' END AS op,
  o.c_acctbal AS before_balance, n.c_acctbal AS after_balance
FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey
WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.c_acctbal IS DISTINCT FROM n.c_acctbal""")
def cdc_events(spark, sf):
    events = C.change_events(*_states(spark, sf), ["c_custkey"])
    return events.select("c_custkey", "op", F.col("before.c_acctbal").alias("before_balance"),
                         F.col("after.c_acctbal").alias("after_balance"))


def _log(spark, sf):
    """`events` as a change log: clicks insert, errors delete, all others update."""
    events = table(spark, sf, "events")
    code = F.when(F.col("event_type") == "click", F.array(F.lit(C.INSERTED))).when(
        F.col("event_type") == "error", F.array(F.lit(C.DELETED))).otherwise(F.array(F.lit(C.BEFORE), F.lit(C.AFTER)))
    log = events.select(
        F.when(F.col("user_id") % 3 == 0, "hot").otherwise("cold").alias("table"),
        F.floor(F.col("event_id") / 3).alias("lsn"), F.posexplode(code).alias("step", "operation"),
        "event_id", "user_id", "value")
    seq = F.col("event_id") * 2 + F.col("step")
    amount = F.when(F.col("operation") == C.BEFORE, F.col("value") - 1).otherwise(F.col("value"))
    return log.select("table", "lsn", seq.alias("seq"), "operation", "user_id", amount.alias("amount"))


_LOG = """log AS (SELECT CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE 'cold' END AS "table", event_id // 3 AS lsn,
  event_id * 2 + step AS seq, CASE event_type WHEN 'click' THEN 2 WHEN 'error' THEN 1 ELSE 3 + step END AS operation,
  user_id, CASE WHEN event_type IN ('click', 'error') OR step = 1 THEN value ELSE value - 1 END AS amount
  FROM (SELECT *, unnest(range(CASE WHEN event_type IN ('click', 'error') THEN 1 ELSE 2 END)) AS step FROM events))"""


@query("cdc_pair_updates", f"""WITH {_LOG},
p AS (SELECT *, lag(amount) OVER (PARTITION BY "table" ORDER BY lsn, seq) AS prior FROM log)
SELECT "table", seq, CASE operation WHEN 2 THEN 'c' WHEN 1 THEN 'd' ELSE 'u' END AS op,
  round(CASE operation WHEN 1 THEN amount WHEN 4 THEN prior END, 4) AS before_amount,
  CASE WHEN operation <> 1 THEN amount END AS after_amount FROM p WHERE operation <> 3""")
def cdc_pair_updates(spark, sf):
    events = C.pair_updates(_log(spark, sf))
    return events.select("table", "seq", "op", F.round("before.amount", 4).alias("before_amount"),
                         F.col("after.amount").alias("after_amount"))


@query("cdc_lsn_window", f"""WITH {_LOG}, p AS (SELECT * FROM log WHERE lsn > 50),
r AS (SELECT "table", lsn, row_number() OVER (PARTITION BY "table" ORDER BY lsn, seq) AS rn FROM p),
e AS (SELECT min(lsn) AS stop FROM r WHERE rn = 501)
SELECT "table", lsn, seq FROM p, e WHERE stop IS NULL OR lsn <= stop""")
def cdc_lsn_window(spark, sf):
    return C.lsn_window(_log(spark, sf), 50, 500).select("table", "lsn", "seq")


@query("cdc_op_map", """SELECT event_id,
 CASE event_type WHEN 'signup' THEN 'c' WHEN 'click' THEN 'u' WHEN 'error' THEN 'd' ELSE 'r' END AS stream_op,
 CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS listener_op,
 CASE WHEN event_type = 'error' THEN 'd' WHEN event_type = 'signup' AND value > 50 THEN 'u' ELSE 'c' END AS warehouse_op FROM events""")
def cdc_op_map(spark, sf):
    def named(**names):
        pairs = [F.lit(x) for pair in names.items() for x in pair]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("event_type")), F.lit("other"))

    rows = table(spark, sf, "events").select(
        "event_id", (F.col("value") > 50).alias("isupdate"),
        named(signup="INSERT", click="modify", error="REMOVE").alias("a"),
        named(signup="added", click="modified", error="removed").alias("b"),
        named(signup="INSERT", error="DELETE").alias("w"))
    out = C.map_op(C.map_op(rows, "stream", "a", into="stream_op"), "listener", "b", into="listener_op")
    return C.map_op(out, "warehouse", "w", "isupdate", "warehouse_op").select("event_id", "stream_op", "listener_op", "warehouse_op")


@query("cdc_key", """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_partkey AS VARCHAR) AS usual, CAST(l_orderkey AS VARCHAR) AS fallback,
  l_orderkey || '_' || l_linenumber AS configured FROM lineitem""")
def cdc_key(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    out = C.cdc_key(rows, into="fallback")
    out = C.cdc_key(out, ["l_orderkey", "l_linenumber"], into="configured")
    return C.cdc_key(out.withColumn("id", F.col("l_partkey")), into="usual").drop("id")


@query("cdc_apply", f"""WITH {_STATES} SELECT {_CUSTOMER} FROM new""")
def cdc_apply(spark, sf):
    old, new = _states(spark, sf)
    events = C.change_events(old, new, ["c_custkey"]).withColumn("at", F.lit(2))
    # an earlier change of every key must lose against the later one
    stale = events.withColumns({"at": F.lit(1), "op": F.when(F.col("op") == "d", "u").otherwise("d"),
                                "after": F.when(F.col("op") == "d", F.col("before"))})
    return C.apply_changes(old, events.unionByName(stale), ["c_custkey"], ["at"])


@query("kv_latest", f"""WITH {RECORDS}
SELECT key, max_by(value, "offset") AS value, max("offset") AS revision, 'Put' AS operation FROM records GROUP BY key
HAVING max_by(event_type, "offset") <> 'error'""")
def kv_latest(spark, sf):
    rows = records(spark, sf)
    log = rows.withColumn("value", F.when(F.col("topic") != "error", F.col("value")))
    return plain(K.latest(log), "key", "value", "revision", "operation")


@query("state_change", """SELECT user_id, event_id, event_type FROM events
QUALIFY lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) IS DISTINCT FROM event_type""")
def state_change(spark, sf):
    return K.on_change(table(spark, sf, "events"), ["user_id"], "event_id", ["event_type"]).select("user_id", "event_id", "event_type")


@query("dedupe", """SELECT l_orderkey, l_linenumber, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY ALL""")
def dedupe(spark, sf):
    rows = K.dedupe(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return rows.select("l_orderkey", "l_linenumber", F.lit(1).cast("long").alias("n"))
