"""Registered queries: write modes and cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import writes as W
from rivulet.plans.inputs import RECORDS, records, table
from rivulet.plans.registry import query

_COLS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
_OLD = f"target AS (SELECT {_COLS} FROM customer WHERE c_mktsegment <> 'BUILDING')"
# every order is an update of its customer; order keys give the sequence
_UPDATES = """updates AS (SELECT o_custkey AS c_custkey, 'order ' || o_orderkey AS c_name, 7 AS c_nationkey, o_totalprice AS c_acctbal,
  o_orderpriority AS c_mktsegment, o_orderkey AS "offset" FROM orders),
last AS (SELECT * FROM updates QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY "offset" DESC) = 1)"""
_PK = ["c_custkey"]


def _target(spark, sf):
    return table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'")


def _updates(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.concat(F.lit("order "), "o_orderkey").alias("c_name"),
        F.lit(7).alias("c_nationkey"), F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"), F.col("o_orderkey").alias("offset"))


@query("write_insert", f"WITH {_OLD}, {_UPDATES} SELECT * FROM target UNION ALL SELECT {_COLS} FROM updates")
def write_insert(spark, sf):
    return W.write_mode(_target(spark, sf), _updates(spark, sf), "insert")


@query("write_create", f"""WITH {_OLD}, {_UPDATES} SELECT * FROM target UNION ALL
SELECT {_COLS} FROM updates WHERE c_custkey NOT IN (SELECT c_custkey FROM target)
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY "offset") = 1""")
def write_create(spark, sf):
    return W.write_mode(_target(spark, sf), _updates(spark, sf), "create", _PK)


@query("write_upsert", f"""WITH {_OLD}, {_UPDATES}
SELECT * FROM target WHERE c_custkey NOT IN (SELECT c_custkey FROM last) UNION ALL SELECT {_COLS} FROM last""")
def write_upsert(spark, sf):
    return W.write_mode(_target(spark, sf), _updates(spark, sf), "upsert", _PK)


@query("write_replace", f"""WITH {_OLD}, {_UPDATES}
SELECT t.c_custkey, CASE WHEN l.c_custkey IS NULL THEN t.c_name ELSE l.c_name END AS c_name,
  CASE WHEN l.c_custkey IS NULL THEN t.c_nationkey END AS c_nationkey,
  CASE WHEN l.c_custkey IS NULL THEN t.c_acctbal ELSE l.c_acctbal END AS c_acctbal,
  CASE WHEN l.c_custkey IS NULL THEN t.c_mktsegment END AS c_mktsegment
FROM target t LEFT JOIN last l USING (c_custkey)""")
def write_replace(spark, sf):
    partial = _updates(spark, sf).drop("c_nationkey", "c_mktsegment")
    return W.write_mode(_target(spark, sf), partial, "replace", _PK)


@query("write_update", f"""WITH {_OLD}, {_UPDATES}
SELECT t.c_custkey, t.c_name, t.c_nationkey, coalesce(l.c_acctbal, t.c_acctbal) AS c_acctbal,
  coalesce(l.c_mktsegment, t.c_mktsegment) AS c_mktsegment FROM target t LEFT JOIN last l USING (c_custkey)""")
def write_update(spark, sf):
    partial = _updates(spark, sf).select("c_custkey", "c_acctbal", "c_mktsegment", "offset")
    return W.write_mode(_target(spark, sf), partial, "update", _PK)


@query("write_merge", f"""WITH {_OLD}, {_UPDATES},
patch AS (SELECT c_custkey, max_by(c_acctbal, "offset") FILTER (c_mktsegment <> '1-URGENT') AS acct,
  count(*) FILTER (c_mktsegment <> '1-URGENT') AS has_acct,
  max("offset") FILTER (c_mktsegment = '1-URGENT') AS urgent FROM updates GROUP BY 1)
SELECT c_custkey, t.c_name, CASE WHEN urgent IS NULL THEN t.c_nationkey END AS c_nationkey,
  CASE WHEN has_acct > 0 THEN acct ELSE t.c_acctbal END AS c_acctbal, t.c_mktsegment
FROM target t FULL JOIN patch p USING (c_custkey)""")
def write_merge(spark, sf):
    urgent = F.col("c_mktsegment") == "1-URGENT"
    present = F.when(urgent, F.array(F.lit("c_nationkey"))).otherwise(F.array(F.lit("c_acctbal")))
    patches = _updates(spark, sf).withColumns({"present": present, "c_nationkey": F.lit(None).cast("int")})
    return W.write_mode(_target(spark, sf), patches.drop("c_name"), "merge", _PK)


@query("write_delete", f"""WITH {_OLD} SELECT * FROM target
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def write_delete(spark, sf):
    gone = _updates(spark, sf).where("c_mktsegment = '1-URGENT'")
    return W.write_mode(_target(spark, sf), gone, "delete", _PK)


@query("write_increment", """WITH t AS (SELECT 'c' || c_custkey AS row_key, 'f' AS family, 'orders' AS "column", c_nationkey AS value FROM customer),
d AS (SELECT 'c' || o_custkey AS row_key, count(*) AS n FROM orders GROUP BY 1)
SELECT coalesce(t.row_key, d.row_key) AS row_key, 'f' AS family, 'orders' AS "column", coalesce(value, 0) + coalesce(n, 0) AS value
FROM t FULL JOIN d ON t.row_key = d.row_key""")
def write_increment(spark, sf):
    def cell(df, key, value):
        return df.select(F.concat(F.lit("c"), key).alias("row_key"), F.lit("f").alias("family"),
                         F.lit("orders").alias("column"), value.alias("value"))

    target = cell(table(spark, sf, "customer"), "c_custkey", F.col("c_nationkey").cast("long"))
    deltas = cell(table(spark, sf, "orders"), "o_custkey", F.lit("1"))
    return W.write_mode(target, deltas, "increment")


@query("write_append_cell", """WITH d AS (SELECT o_custkey, string_agg(o_orderstatus, '' ORDER BY o_orderkey) AS tail FROM orders GROUP BY 1)
SELECT 'c' || coalesce(c_custkey, o_custkey) AS row_key, 'f' AS family, 'history' AS "column",
  coalesce(c_mktsegment, '') || coalesce(tail, '') AS value FROM customer FULL JOIN d ON c_custkey = o_custkey""")
def write_append_cell(spark, sf):
    def cell(df, key, value, *more):
        return df.select(F.concat(F.lit("c"), key).alias("row_key"), F.lit("f").alias("family"),
                         F.lit("history").alias("column"), F.col(value).alias("value"), *more)

    target = cell(table(spark, sf, "customer"), "c_custkey", "c_mktsegment")
    pieces = cell(table(spark, sf, "orders"), "o_custkey", "o_orderstatus", F.col("o_orderkey").alias("offset"))
    return W.write_mode(target, pieces, "append")


@query("cells_melt", f"""WITH {RECORDS},
f AS (SELECT 'u' || key AS row_key, 'd' AS family, unnest(['type', 'value']) AS "column",
  unnest([event_type, CAST(number AS VARCHAR)]) AS value, "timestamp" AS ts FROM records WHERE number >= 50),
m AS (SELECT key AS row_key, unnest(['a', 'b']) AS family, unnest(['k', 'n']) AS "column",
  unnest([json_extract_string(props, '$.k'), CAST("offset" AS VARCHAR)]) AS value, "timestamp" AS ts FROM records WHERE number < 50)
SELECT * FROM f UNION ALL SELECT * FROM m""")
def cells_melt(spark, sf):
    rows = records(spark, sf)
    text = F.col("value").cast("string")
    amount, key = F.get_json_object(text, "$.value"), F.col("key").cast("string")
    flat = F.concat(F.lit('{"row_key":"u'), key, F.lit('","type":"'), "topic", F.lit('","value":'), amount, F.lit("}"))
    nested = F.concat(F.lit('{"families":{"a":'), F.get_json_object(text, "$.props"), F.lit(',"b":{"n":'), "offset", F.lit("}}}"))
    shaped = rows.withColumn("value", F.when(amount.cast("double") >= 50, flat).otherwise(nested))
    return W.to_cells(shaped, default_family="d")


@query("schema_align", """SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS p_comment, CAST(p_size AS BIGINT) AS p_size,
  CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part""")
def schema_align(spark, sf):
    from pyspark.sql.types import LongType, StringType, StructType

    want = StructType().add("p_partkey", LongType()).add("p_name", StringType()).add("p_comment", StringType())
    want = want.add("p_size", LongType()).add("p_retailprice", StringType())
    parts = table(spark, sf, "part").withColumnsRenamed({"p_partkey": "P_PartKey", "p_name": "P_NAME"})
    return W.align(parts, want)
