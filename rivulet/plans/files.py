"""Registered queries: sources, sinks and captured messages. Files are written from the given tables first."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from rivulet.operators import writes as W
from rivulet.plans.inputs import RECORDS, plain, records, scratch, table
from rivulet.plans.registry import query
from rivulet.sinks import files as S, tables as B
from rivulet.sources import delimited as L, files as I, frames as M, generate as G, incremental as C

_CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
_AS_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _CUSTOMER.split(", "))


@query("csv_scan", f"SELECT {_AS_TEXT}, CAST(c_custkey AS VARCHAR) AS key FROM customer")
def csv_scan(spark, sf):
    folder = scratch(spark)
    padded = table(spark, sf, "customer").withColumn("c_name", F.concat(F.lit("  "), "c_name", F.lit(" ")))
    S.write_csv(padded, folder, delimiter=";")
    return I.read_csv(spark, f"{folder};{folder}-missing", delimiter=";", trim=True, key_field="c_custkey").drop("source_file")


@query("csv_split", """SELECT CAST(doc_id AS VARCHAR) AS doc_id, '"' || source || '", ' || lang AS origin, replace(text, '.', '"' || chr(13) || chr(10)) AS text FROM documents""")
def csv_split(spark, sf):
    """Quotes and line breaks in most values, read in byte ranges."""
    folder = scratch(spark)
    docs = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit('"'), "source", F.lit('", '), "lang").alias("origin"), F.replace(F.col("text"), F.lit("."), F.lit('"\r\n')).alias("text"))
    docs.write.csv(folder, header=True, quote='"', escape='"', quoteAll=True, lineSep="\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return L.read_large_csv(spark, [folder]).drop("source_file")


@query("csv_sink", """SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, '{"source":"' || source || '","n":' || n_chars || '}' AS origin, CAST(NULL AS VARCHAR) AS note FROM documents""")
def csv_sink(spark, sf):
    folder = scratch(spark)
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", "lang", F.struct("source", F.col("n_chars").alias("n")).alias("origin"), F.lit(None).cast("string").alias("note"))
    S.write_csv(docs, folder, max_records=300)
    return I.read_csv(spark, folder).drop("source_file")


@query("parquet_scan", "SELECT event_id, user_id, value, event_id AS row_index, 'events.parquet' AS file FROM events")
def parquet_scan(spark, sf):
    rows = I.read_parquet(spark, f"{sf}/events.parquet")
    return rows.select("event_id", "user_id", "value", "row_index", F.element_at(F.split("source_file", "/"), -1).alias("file"))


@query("parquet_sink", f"SELECT {_AS_TEXT}, '' AS note, c_custkey AS typed FROM customer")
def parquet_sink(spark, sf):
    folder = scratch(spark)
    rows = table(spark, sf, "customer")
    S.write_parquet(rows, f"{folder}/typed", codec="gzip", row_group_bytes=1 << 20)
    S.write_parquet(rows.withColumn("note", F.lit(None).cast("string")), f"{folder}/text", codec="zstd", as_text=True, max_records=500)
    typed = spark.read.parquet(f"{folder}/typed").select(F.col("c_custkey").alias("typed"))
    text = spark.read.parquet(f"{folder}/text")
    return text.join(typed, text.c_custkey == typed.typed.cast("string"))


_JSON = """'{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}'"""


@query("json_array_scan", f"""SELECT {_JSON} AS value FROM customer UNION ALL SELECT '{{"one":' || n_nationkey || '}}' FROM nation
UNION ALL SELECT 'broken [' || r_regionkey FROM region""")
def json_array_scan(spark, sf):
    folder = scratch(spark)
    S.write_json(table(spark, sf, "customer").select("c_custkey", "c_name").repartition(3), f"{folder}/arrays", lines=False)

    def single(name, value):
        S._limited(table(spark, sf, name).select(value.alias("value")), "append", 1).text(f"{folder}/{name}")

    single("nation", F.concat(F.lit('{"one":'), "n_nationkey", F.lit("}")))
    single("region", F.concat(F.lit("broken ["), "r_regionkey"))
    out = [I.read_json_objects(spark, f"{folder}/{kind}") for kind in ("arrays", "nation", "region")]
    return out[0].unionByName(out[1]).unionByName(out[2]).select(F.trim(F.regexp_replace("value", "\n$", "")).alias("value"))


@query("jsonl_scan", f"SELECT {_JSON} AS value FROM customer")
def jsonl_scan(spark, sf):
    folder = scratch(spark)
    lines = F.concat(F.lit("  "), F.to_json(F.struct("c_custkey", "c_name")), F.lit(" \n"))
    S.write_text(table(spark, sf, "customer").select(lines.alias("value")), folder)
    return I.read_jsonl(spark, folder).select("value")


@query("raw_object_scan", """SELECT CAST(l_linenumber AS INTEGER) AS folder, CAST(sum(length(l_orderkey || ':' || l_returnflag) + 1) AS BIGINT) AS bytes
FROM lineitem GROUP BY 1""")
def raw_object_scan(spark, sf):
    folder = scratch(spark)
    lines = table(spark, sf, "lineitem").select("l_linenumber", F.concat_ws(":", "l_orderkey", "l_returnflag").alias("value"))
    lines.write.partitionBy("l_linenumber").text(folder)
    objects = I.read_raw(spark, f"{folder}/*")
    place = F.regexp_extract("source_file", "l_linenumber=(\\d+)", 1).cast("int")
    return objects.groupBy(place.alias("folder")).agg(F.sum("length").alias("bytes"))


@query("glob_select", """SELECT page_id, url FROM pages
WHERE regexp_matches(url, '(?i)^http.*://.*/(en|de)/[^/]*$') AND NOT regexp_matches(url, '(?i)^https://m\\..*$')""")
def glob_select(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    kept = [I.filter_paths(pages, f"HTTP*//**/{lang}/*", "https://M.**", "url") for lang in ("en", "de")]
    return kept[0].unionByName(kept[1])


@query("json_path_rows", f"""WITH {RECORDS}
SELECT "offset", CAST(i AS INTEGER) AS index, CASE i WHEN 0 THEN '"' || event_type || '"' ELSE CAST(user_id AS VARCHAR) END AS value
FROM (SELECT *, unnest([0, 1]) AS i FROM records WHERE number >= 30)
UNION ALL SELECT "offset", 0, props FROM (SELECT "offset", '{{"k":' || json_extract_string(props, '$.k') || '}}' AS props FROM records WHERE number < 30 AND number >= 10)""")
def json_path_rows(spark, sf):
    events = table(spark, sf, "events")
    nodes = F.concat(F.lit('{"data":{"nodes":["'), "event_type", F.lit('",'), "user_id", F.lit("]}}"))
    single = F.concat(F.lit('{"data":{"nodes":'), "props", F.lit("}}"))
    value = F.when(F.col("value") >= 30, nodes).when(F.col("value") >= 10, single).otherwise(F.lit('{"data":{}}'))
    return I.extract_rows(events.select(F.col("event_id").alias("offset"), value.alias("value")), "data.nodes")


_LINES = "(SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)"


@query("framed_split", f"""SELECT 'line' AS framing, doc_id, len(list_filter(parts[:-2], lambda x: x <> '')) AS frames,
  CAST(coalesce(list_sum(list_transform(parts[:-2], lambda x: length(x))), 0) AS BIGINT) AS chars FROM {_LINES}
UNION ALL SELECT 'delimiter', doc_id, len(list_filter(string_split(text, '. ')[:-2], lambda x: x <> '')),
  CAST(coalesce(list_sum(list_transform(string_split(text, '. ')[:-2], lambda x: length(x))), 0) AS BIGINT) FROM documents
UNION ALL SELECT 'length', doc_id, 2, length(text) + length(lang) FROM documents""")
def framed_split(spark, sf):
    docs = table(spark, sf, "documents")

    def prefixed(name):
        size = F.lpad(F.hex(F.octet_length(name)), 8, "0")
        return F.concat(F.unhex(size), F.col(name).cast("binary"))

    blobs = docs.select("doc_id", F.col("text").cast("binary").alias("value"))
    packets = docs.select("doc_id", F.concat(prefixed("text"), prefixed("lang"), F.unhex(F.lit("000000"))).alias("value"))
    out = []
    for framing, rows, more in (("line", blobs, {}), ("delimiter", blobs, {"delimiter": b". "}), ("length", packets, {})):
        frames = M.split_frames(rows, framing=framing, **more)
        counted = frames.groupBy("doc_id").agg(F.count("*").alias("frames"), F.sum(F.length(F.col("frame").cast("string"))).alias("chars"))
        counted = docs.select("doc_id").join(counted, "doc_id", "left").na.fill(0)
        out.append(counted.select(F.lit(framing).alias("framing"), "doc_id", "frames", "chars"))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("sse_events", """SELECT conv_id, role AS event, conv_id || '-' || turn AS id, text AS data FROM conversations WHERE role <> 'system'""")
def sse_events(spark, sf):
    chats = table(spark, sf, "conversations")
    data = F.concat(F.lit("data: "), F.regexp_replace("text", "\n", "\ndata: "))
    block = F.concat(F.lit(": turn\nevent:"), "role", F.lit("\nid: "), "conv_id", F.lit("-"), "turn", F.lit("\n"),
                     F.when(F.col("role") != "system", F.concat(data, F.lit("\n"))).otherwise(""), F.lit("retry: 5\n\ndata: unfinished"))
    return M.parse_sse(chats.select("conv_id", block.alias("value"))).select("conv_id", "event", "id", "data")


def _meetings(spark, sf):
    """Every order as a calendar event of its priority."""
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("topic"), F.col("o_orderkey").alias("offset"),
        F.concat(F.lit("order-"), "o_orderkey").alias("uid"),
        F.concat(F.lit("Order, "), "o_orderstatus", F.lit("; "), F.col("o_totalprice").cast("string"), F.lit(" \\ "), F.repeat(F.lit("more "), 20)).alias("summary"),
        F.col("o_orderdate").alias("start"), F.col("o_orderstatus").alias("status"))


@query("ics_sink", """WITH o AS (SELECT *, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) // 200 AS file,
  'SUMMARY:Order' || chr(92) || ', ' || o_orderstatus || chr(92) || '; ' || o_totalprice || ' ' || chr(92) || chr(92) || ' ' || repeat('more ', 20) AS s FROM orders),
e AS (SELECT *, array_to_string(['BEGIN:VEVENT', 'UID:order-' || o_orderkey,
  array_to_string(list_transform(range(0, (length(s) + 72) // 73), lambda i: substr(s, 73 * i + 1, 73)), chr(13) || chr(10) || ' '),
  'DTSTART:' || strftime(o_orderdate, '%Y%m%dT%H%M%S'), 'DTEND:' || strftime(o_orderdate + INTERVAL 1 HOUR, '%Y%m%dT%H%M%S'),
  'STATUS:' || o_orderstatus, 'END:VEVENT'], chr(13) || chr(10)) AS event FROM o)
SELECT o_orderpriority AS topic, file, CAST(count(*) AS INTEGER) AS events, array_to_string(['BEGIN:VCALENDAR', 'VERSION:2.0',
  'PRODID:-//rivulet//EN', 'X-WR-CALNAME:Events', string_agg(event, chr(13) || chr(10) ORDER BY o_orderkey), 'END:VCALENDAR', ''], chr(13) || chr(10)) AS value FROM e GROUP BY ALL""")
def ics_sink(spark, sf):
    return S.to_ics(_meetings(spark, sf), max_events=200)


@query("ics_events", """SELECT 'order-' || o_orderkey AS uid, 'Order, ' || o_orderstatus || '; ' || o_totalprice || ' \\ ' || repeat('more ', 20) AS summary,
  o_orderstatus AS status, o_orderdate AS start, o_orderdate + INTERVAL 1 HOUR AS "end",
  'order-' || o_orderkey || '_' || strftime(o_orderdate, '%Y%m%d%H%M%S') AS event_key, epoch_us(o_orderdate) // 1000 AS stamp_ms
FROM orders WHERE o_orderdate + INTERVAL 1 HOUR >= TIMESTAMP '1996-03-01' AND o_orderdate <= TIMESTAMP '1997-03-01' AND o_orderstatus <> 'P'""")
def ics_events(spark, sf):
    folder = scratch(spark)
    S.write_ics(_meetings(spark, sf), folder, max_events=500)
    seen = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(
        F.concat(F.lit("order-"), "o_orderkey", F.lit("_"), F.date_format("o_orderdate", "yyyyMMddHHmmss")).alias("event_key"))
    events = M.read_ics(spark, folder, datetime(1996, 3, 1), 365, seen=seen)
    return events.select("uid", "summary", "status", "start", "end", "event_key", "stamp_ms")


@query("sequence_sources", """SELECT 0 AS source_index, 'all' AS topic, event_id AS "offset", event_type AS value FROM events
UNION ALL SELECT 2, 'all', o_orderkey, o_orderstatus FROM orders""")
def sequence_sources(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_id").alias("offset"), F.col("event_type").alias("value"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("offset"), F.col("o_orderstatus").alias("value"))
    broken = lambda: spark.read.parquet(f"{sf}/no-such-table.parquet")
    return I.concat_sources([events, broken, orders], "all", continue_on_error=True)


@query("generate", """SELECT 'made' AS topic, event_id AS "offset", 'k' || (10 + event_id * 5) AS key,
  '{"seq":' || (10 + event_id * 5) || ',"part":0,"again":' || (10 + event_id * 5) || '}' AS value, true AS in_range, 8 AS letters FROM events""")
def generate(spark, sf):
    ids = table(spark, sf, "events").select(F.col("event_id").alias("id"))
    template = '{"seq":${sequence},"part":${partition},"again":${sequence}}|${random_int}|${random_string}|${random_int}'
    rows = G.generate(spark, key="k${sequence}", value=template, topic="made", start=10, step=5, seed=7, int_range=(5, 9),
                      string_length=8, ids=ids)
    parts = F.split(F.col("value").cast("string"), "\\|")
    valid = F.get(parts, F.lit(1)).cast("int").between(5, 9) & (F.get(parts, F.lit(1)) == F.get(parts, F.lit(3)))
    return rows.select("topic", "offset", F.col("key").cast("string").alias("key"), F.get(parts, F.lit(0)).alias("value"),
                       valid.alias("in_range"), F.length(F.get(parts, F.lit(2))).alias("letters"))


@query("incr_lookback", """SELECT o_orderkey, o_orderdate, 'stored' AS origin FROM orders WHERE o_orderdate > TIMESTAMP '1999-05-01'
UNION ALL SELECT o_orderkey, o_orderdate, 'lookback' FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01' - INTERVAL 90 DAY""")
def incr_lookback(spark, sf):
    folder = scratch(spark)
    for day in (datetime(1998, 1, 1), datetime(1999, 5, 1)):
        C.save_mark(spark, folder, "orders", day)
    store = spark.read.parquet(folder)
    orders, now = table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), datetime(2000, 1, 1)
    out = []
    for source, origin in (("orders", "stored"), ("unknown", "lookback")):
        start = C.initial_mark(store, source, now, 90 * 86400)
        rows = C.incremental(orders, "timestamp", ts_col="o_orderdate", last=start)
        out.append(rows.withColumn("origin", F.lit(origin)))
    return out[0].unionByName(out[1])


@query("schema_infer", f"""WITH {RECORDS}, k AS (SELECT unnest(json_keys(value)) AS name, value FROM records)
SELECT name, CASE max(json_type(value, '$.' || name)) WHEN 'VARCHAR' THEN 'string' WHEN 'UBIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
  WHEN 'OBJECT' THEN 'variant' END AS type FROM k GROUP BY name""")
def schema_infer(spark, sf):
    schema = W.infer(records(spark, sf))
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema], "name string, type string")


@query("load_disposition", f"SELECT {_CUSTOMER} FROM customer UNION ALL SELECT {_CUSTOMER} FROM customer WHERE c_acctbal < 0")
def load_disposition(spark, sf):
    folder = scratch(spark)
    rows = table(spark, sf, "customer")
    B.load(rows.where("c_acctbal > 9000"), folder)
    B.load(rows, folder, "truncate")
    B.load(rows.where("c_acctbal < 0"), folder, "append")
    return spark.read.parquet(folder)


@query("json_sink", f"WITH {RECORDS} SELECT topic, \"offset\", key, value FROM records")
def json_sink(spark, sf):
    folder = scratch(spark)
    rows = plain(records(spark, sf), "topic", "offset", "key", "value")
    S.write_json(rows, folder, max_records=4000)
    return spark.read.schema(rows.schema).json(folder)


@query("text_sink", f"WITH {RECORDS} SELECT value, count(*) AS n FROM records GROUP BY value")
def text_sink(spark, sf):
    folder = scratch(spark)
    S.write_text(records(spark, sf), folder)
    return spark.read.text(folder).groupBy("value").agg(F.count("*").alias("n"))


@query("partitioned_sink", f"""WITH {RECORDS}
SELECT 'day' AS layout, topic, strftime("timestamp", '%Y-%m-%d') AS folder, count(*) AS n,
  CAST(sum("offset") AS BIGINT) AS offsets FROM records GROUP BY ALL
UNION ALL SELECT 'partition', topic, CAST("partition" AS VARCHAR), count(*), CAST(sum("offset") AS BIGINT) FROM records GROUP BY ALL
UNION ALL SELECT 'segment', 'customers', CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE regexp_replace(c_mktsegment, 'I', '_', 'g') END, count(*),
  CAST(sum(c_custkey) AS BIGINT) FROM customer GROUP BY ALL""")
def partitioned_sink(spark, sf):
    folder = scratch(spark)
    rows = records(spark, sf)
    S.write_partitioned(rows, f"{folder}/day", "day", "parquet", files_per_folder=2)
    S.write_partitioned(rows, f"{folder}/partition", "partition", "json")
    segment = F.regexp_replace("c_mktsegment", "I", "/")
    payload = F.when(F.col("c_acctbal") < 0, F.lit('{"segment":null}')).otherwise(F.to_json(F.struct(segment.alias("segment"))))
    S.write_partitioned(table(spark, sf, "customer").select(F.lit("customers").alias("topic"), F.col("c_custkey").alias("offset"), payload.alias("value")),
                        f"{folder}/segment", "segment", "json")
    read = {
        "day": (spark.read.parquet(f"{folder}/day"), F.col("day").cast("string")),
        "partition": (spark.read.json(f"{folder}/partition"), F.col("partition").cast("string")),
        "segment": (spark.read.json(f"{folder}/segment"), F.col("segment")),
    }
    out = None
    for layout, (frame, place) in read.items():
        part = frame.groupBy(F.lit(layout).alias("layout"), F.col("topic").cast("string").alias("topic"), place.alias("folder")).agg(
            F.count("*").alias("n"), F.sum("offset").alias("offsets"))
        out = part if out is None else out.unionByName(part)
    return out


@query("script_source", "SELECT event_id, upper(event_type) AS kind, value * 2 AS doubled FROM events")
def script_source(spark, sf):
    import pyarrow.parquet as pq

    from rivulet.sources.script import register_script

    path = f"{sf}/events.parquet"

    def script(group):
        rows = pq.ParquetFile(path).read_row_group(group, ["event_id", "event_type", "value"])
        for row in rows.to_pylist():
            yield row["event_id"], row["event_type"].upper(), row["value"] * 2

    register_script(spark, "event_script", script, "event_id long, kind string, doubled double")
    return spark.read.format("event_script").option("partitions", pq.ParquetFile(path).num_row_groups).load()
