"""Registered queries: aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import aggregation as A
from rivulet.plans.inputs import RECORDS, records, table
from rivulet.plans.registry import query

_TYPES = {"count": "count(*)", "sum": "sum(number)", "avg": "sum(number) / count(*)", "min": "min(number)", "max": "max(number)"}


def _windowed(op):
    return f"""WITH {RECORDS}
SELECT event_type AS "group", '{op}' AS operation, round(CAST({_TYPES[op]} AS DOUBLE), 9) AS result, count(*) AS count,
       time_bucket(INTERVAL 1 HOUR, "timestamp") + INTERVAL 1 HOUR AS window_end
FROM records GROUP BY event_type, time_bucket(INTERVAL 1 HOUR, "timestamp")"""


def _rounded(df):
    return df.withColumn("result", F.round("result", 9))


def _register(op):
    @query(f"agg_{op}", _windowed(op))
    def run(spark, sf):
        return _rounded(A.aggregate(records(spark, sf), op, "value", "type", window="1 hour"))


for _op in _TYPES:
    _register(_op)


@query("agg_global", """SELECT '_all' AS "group", 'sum' AS operation, round(sum(value), 2) AS result, count(*) AS count FROM events""")
def agg_global(spark, sf):
    out = A.aggregate(records(spark, sf), "sum", "value")
    return out.withColumn("result", F.round("result", 2))


@query("agg_null_group", """SELECT CASE WHEN value < 20 THEN '_all' WHEN value < 60 THEN '_null' ELSE event_type END AS "group",
       'count' AS operation, CAST(count(*) AS DOUBLE) AS result, count(*) AS count FROM events GROUP BY ALL""")
def agg_null_group(spark, sf):
    broken = (
        F.when(F.col("value") < 20, F.lit("not json"))
        .when(F.col("value") < 60, F.concat(F.lit('{"value":'), "value", F.lit("}")))
        .otherwise(F.concat(F.lit('{"type":"'), "event_type", F.lit('"}')))
    )
    events = table(spark, sf, "events")
    return A.aggregate(events.select(broken.alias("value")), "count", group_by="type")


@query("agg_nested", f"""WITH {RECORDS}
SELECT 'u' || user_id AS "group", 'avg' AS operation,
       round(sum(CAST(json_extract_string(props, '$.k') AS DOUBLE)) / count(*), 9) AS result, count(*) AS count
FROM records GROUP BY user_id""")
def agg_nested(spark, sf):
    return A.aggregate(records(spark, sf), "avg", "props.k", "user.name").withColumn("result", F.round("result", 9))


@query("agg_window", """SELECT CAST(user_id AS VARCHAR) AS "group", 'max' AS operation, max(value) AS result, count(*) AS count,
       time_bucket(INTERVAL 60 SECOND, ts) + INTERVAL 60 SECOND AS window_end
FROM events GROUP BY user_id, time_bucket(INTERVAL 60 SECOND, ts)""")
def agg_window(spark, sf):
    return A.aggregate(records(spark, sf), "max", "value", "user.id", window="60 seconds")


@query("agg_merge", """SELECT event_type AS "group", 'avg' AS operation, round(sum(value) / count(*), 9) AS result, count(*) AS count
FROM events GROUP BY event_type""")
def agg_merge(spark, sf):
    rows = records(spark, sf)
    parts = [A.partials(rows.where(F.col("partition") == p), "value", "type") for p in range(4)]
    return _rounded(A.finish(A.merge_partials(*parts), "avg"))


SESSIONS = """WITH p AS (SELECT event_type, ts, value, lag(ts) OVER w AS before FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
s AS (SELECT *, count(*) FILTER (before IS NULL OR ts - before > INTERVAL 4 MINUTE) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k
  FROM (SELECT * FROM p ORDER BY ts)),
w AS (SELECT event_type AS "group", round(sum(value), 4) AS result, count(*) AS count, min(ts) AS window_start, max(ts) + INTERVAL 4 MINUTE AS window_end
  FROM s GROUP BY event_type, k)
SELECT "group", 'sum' AS operation, result, count, window_start, window_end FROM w"""


@query("session_window", SESSIONS)
def session_window(spark, sf):
    out = A.aggregate(records(spark, sf), "sum", "value", "type", session="4 minutes")
    return out.withColumns({"result": F.round("result", 4), **{c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}})


@query("ledger_balance", """WITH given AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, CAST(l_suppkey AS VARCHAR) AS debtor,
         CAST(1000000 + l_partkey AS VARCHAR) AS creditor, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount FROM lineitem),
once AS (SELECT * FROM given QUALIFY row_number() OVER (PARTITION BY id ORDER BY debtor, creditor, amount) = 1),
legs AS (SELECT CAST(debtor AS BIGINT) AS account, amount AS debit, 0 AS credit FROM once
  UNION ALL SELECT CAST(creditor AS BIGINT), 0, amount FROM once),
accounts AS (SELECT s_suppkey AS account FROM supplier UNION ALL SELECT 1000000 + p_partkey FROM part),
sums AS (SELECT account, sum(debit) AS d, sum(credit) AS c, count(*) AS legs FROM legs GROUP BY account)
SELECT CAST(a.account AS VARCHAR) AS account, 1 AS ledger, 1 AS code, CAST(coalesce(d, 0) AS BIGINT) AS debits_posted,
       CAST(coalesce(c, 0) AS BIGINT) AS credits_posted, coalesce(legs, 0) AS legs
FROM accounts a LEFT JOIN sums USING (account)""")
def ledger_balance(spark, sf):
    transfers = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("id"),
        F.col("l_suppkey").alias("debit_account_id"),
        (F.col("l_partkey") + 1000000).alias("credit_account_id"),
        F.round(F.col("l_extendedprice") * 100).cast("decimal(38,0)").alias("amount"),
    )
    accounts = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id")).unionByName(
        table(spark, sf, "part").select((F.col("p_partkey") + 1000000).alias("id")))
    out = A.balances(transfers, accounts)
    return out.withColumns({c: F.col(c).cast("long") for c in ("debits_posted", "credits_posted")})


@query("ledger_rejects", """WITH t AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, l_suppkey AS account,
         l_quantity - 25 + CASE WHEN l_linenumber = 2 THEN 0.5 ELSE 0 END AS amount FROM lineitem)
SELECT id, CASE WHEN amount < 0 THEN 'amount negative' ELSE 'amount not whole' END AS reason
FROM t WHERE amount < 0 OR amount <> floor(amount)""")
def ledger_rejects(spark, sf):
    transfers = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("id"),
        F.col("l_suppkey").alias("debit_account_id"), F.col("l_partkey").alias("credit_account_id"),
        (F.col("l_quantity") - 25 + F.when(F.col("l_linenumber") == 2, 0.5).otherwise(0.0)).alias("amount"),
    )
    return A.invalid_transfers(transfers).select("id", "reason")


_TAKEN = """WITH t AS (SELECT l_orderkey || '-' || l_partkey % 3 AS id, l_orderkey * 10 + l_linenumber AS seq, CAST(l_suppkey % 4 AS VARCHAR) AS debtor,
  CAST(100 + l_partkey % 3 AS VARCHAR) AS creditor, CAST(l_quantity AS BIGINT) // 20 AS amount FROM lineitem),
f AS (SELECT *, first_value(struct_pack(a := debtor, b := creditor, c := amount)) OVER (PARTITION BY id ORDER BY seq, debtor, creditor, amount) AS first,
  row_number() OVER (PARTITION BY id ORDER BY seq, debtor, creditor, amount) AS r FROM t)"""


def _taken(spark, sf):
    """Transfers many of which share their id with others, some with the same content."""
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", F.col("l_partkey") % 3).alias("id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        (F.col("l_suppkey") % 4).alias("debit_account_id"), (100 + F.col("l_partkey") % 3).alias("credit_account_id"),
        F.floor(F.col("l_quantity").cast("long") / 20).cast("decimal(38,0)").alias("amount"))


@query("ledger_first", f"""{_TAKEN}, legs AS (SELECT debtor AS account, amount AS debit, 0 AS credit FROM f WHERE r = 1
  UNION ALL SELECT creditor, 0, amount FROM f WHERE r = 1)
SELECT account, CAST(sum(debit) AS BIGINT) AS debits_posted, CAST(sum(credit) AS BIGINT) AS credits_posted, count(*) AS legs FROM legs GROUP BY account""")
def ledger_first(spark, sf):
    out = A.balances(_taken(spark, sf), order=["seq"])
    return out.select("account", *[F.col(c).cast("long").alias(c) for c in ("debits_posted", "credits_posted")], "legs")


@query("ledger_taken", f"""{_TAKEN} SELECT id, seq, 'id taken by another transfer' AS reason FROM f
WHERE first <> struct_pack(a := debtor, b := creditor, c := amount)""")
def ledger_taken(spark, sf):
    return A.invalid_transfers(_taken(spark, sf), order=["seq"]).select("id", "seq", "reason")


@query("replication_metrics", f"""WITH {RECORDS}
SELECT topic, "partition", count(*) AS records, CAST(sum(strlen(key) + strlen(value)) AS BIGINT) AS bytes,
       max("offset") AS last_offset FROM records GROUP BY topic, "partition\"""")
def replication_metrics(spark, sf):
    return A.replication_metrics(records(spark, sf))
