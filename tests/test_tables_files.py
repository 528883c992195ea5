"""Write modes, files, captured messages, time series, graphs and streams on small cases."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from rivulet.operators import graph as G, points as P, replication as M, writes as W
from rivulet.sinks import files as S, tables as B
from rivulet.sources import delimited as L, files as I, frames as X, generate as Gen, incremental as C, jdbc, script
from rivulet.streaming import queries as Q


def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, name string, n int")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_modes(spark):
    updates = spark.createDataFrame([(2, "old", 1, 1), (2, "new", 2, 2), (3, "c", 30, 3)], "id int, name string, n int, offset long")
    run = lambda mode, u=updates: rows(W.write_mode(target(spark), u, mode, ["id"]))
    assert run("upsert") == [(1, "a", 10), (2, "new", 2), (3, "c", 30)]
    assert run("create") == [(1, "a", 10), (2, "b", 20), (3, "c", 30)]
    assert run("update") == [(1, "a", 10), (2, "new", 2)]
    assert run("update", updates.select("id", "offset")) == [(1, "a", 10), (2, "b", 20)]
    assert W.write_mode(target(spark), updates.drop("n"), "replace", ["id"]).where("id = 2").first().n is None
    assert run("upsert", updates.drop("name")).count((2, "b", 2)) == 1
    assert run("delete") == [(1, "a", 10)]
    assert len(run("insert")) == 5
    with pytest.raises(ValueError):
        W.write_mode(target(spark), updates.drop("id"), "upsert", ["id"])
    with pytest.raises(PySparkException, match="lacks a value"):
        run("upsert", updates.withColumn("id", F.lit(None).cast("int")))


def test_patch_keeps_absent_and_sets_null(spark):
    schema = "id int, name string, place struct<city:string,zip:string>, present array<string>, offset long"
    table = spark.createDataFrame([(1, "a", ("x", "1")), (2, "b", None)], "id int, name string, place struct<city:string,zip:string>")
    patches = spark.createDataFrame([
        (1, None, ("y", None), ["place.city"], 1), (1, None, None, ["name"], 2), (2, None, ("z", "9"), ["place"], 1), (3, "n", None, ["name"], 1)], schema)
    got = {r.id: (r.name, r.place and tuple(r.place)) for r in W.write_mode(table, patches, "merge", ["id"]).collect()}
    assert got == {1: (None, ("y", "1")), 2: ("b", ("z", "9")), 3: ("n", None)}


def test_cells(spark):
    cells = spark.createDataFrame([("r", "f", "c", 5)], "row_key string, family string, column string, value long")
    deltas = spark.createDataFrame([("r", "f", "c", "2"), ("r", "f", "d", "3")], "row_key string, family string, column string, value string")
    assert rows(W.write_mode(cells, deltas, "increment")) == [("r", "f", "c", 7), ("r", "f", "d", 3)]
    with pytest.raises(PySparkException, match="not an integer"):
        W.write_mode(cells, deltas.withColumn("value", F.lit("x")), "increment").collect()


def test_inferred_schema(spark):
    df = spark.createDataFrame([('{"a":1,"b":1.5,"c":"x","d":true,"e":[1],"f":{"g":1}}',), ('{"a":2,"h":null}',)], "value string")
    kinds = {f.name: f.dataType.simpleString() for f in W.infer(df)}
    assert kinds == {"a": "bigint", "b": "double", "c": "string", "d": "boolean", "e": "variant", "f": "variant", "h": "string"}
    assert W.typed_payload(df).count() == 2


def test_csv_cases(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,description\nAlice,"Hello, World"\n\nBob,"Line 1\nLine 2"\n')
    got = I.read_csv(spark, f"{tmp_path}/a.csv;{tmp_path}/missing.csv", key_field="name")
    assert [(r.key, r.description) for r in got.orderBy("name").collect()] == [("Alice", "Hello, World"), ("Bob", "Line 1\nLine 2")]
    assert got.first().source_file.endswith("a.csv")
    (tmp_path / "b.csv").write_bytes("Ä;30\nB;25\n".encode("latin-1"))
    bare = I.read_csv(spark, f"{tmp_path}/b.csv", delimiter=";", header=False, encoding="iso-8859-1")
    assert rows(bare.select("field_0", "field_1")) == [("B", "25"), ("Ä", "30")]
    assert I.read_csv(spark, f"{tmp_path}/none.csv").count() == 0


def test_rolling_and_layouts(spark, tmp_path):
    df = spark.range(10).select(F.lit("t").alias("topic"), F.col("id").alias("offset"), F.lit('{"kind":"a b/c"}').alias("value"),
                                F.expr("timestamp'2024-01-01 05:00:00' + make_interval(0,0,0,0,cast(id as int))").alias("timestamp")).coalesce(1)
    S.write_csv(df.select("offset"), f"{tmp_path}/csv", max_records=4)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 3
    S.write_partitioned(df, f"{tmp_path}/time", "time")
    assert (tmp_path / "time/topic=t/day=2024-01-01/hour=05").is_dir()
    S.write_partitioned(df, f"{tmp_path}/field", "kind", files_per_folder=2)
    assert (tmp_path / "field/topic=t/kind=a_b_c").is_dir()
    S.write_json(df.select("offset"), f"{tmp_path}/array", lines=False)
    assert I.read_json_objects(spark, f"{tmp_path}/array").count() == 10


def test_globs(spark):
    df = spark.createDataFrame([("src/a.py",), ("src/x/b.PY",), ("docs/a.md",)], "path string")
    keep = lambda *a: [r.path for r in I.filter_paths(df, *a).collect()]
    assert keep("src/*.py") == ["src/a.py"]
    assert keep("**.py") == ["src/a.py", "src/x/b.PY"]
    assert keep("**", "docs/?.md") == ["src/a.py", "src/x/b.PY"]
    assert keep() == ["src/a.py", "src/x/b.PY", "docs/a.md"]


def framed(spark, data, **options):
    df = spark.createDataFrame([(bytearray(data),)], "value binary")
    return [bytes(r.frame) for r in X.split_frames(df, **options).orderBy("frame_index").collect()]


def test_frames(spark):
    assert framed(spark, b"a\r\n\n\xff\nrest") == [b"a", b"\xff"]
    assert framed(spark, b"abcdef\nxy\n", max_size=4) == [b"abcd", b"xy"]
    assert framed(spark, b"a||b|||c||", framing="delimiter", delimiter=b"||") == [b"a", b"b", b"|c"]
    assert framed(spark, b"\x02\x00ab\x00\x00\x01\x00c\x05", framing="length", width=2, big_endian=False) == [b"ab", b"", b"c"]
    with pytest.raises(PySparkException, match="exceeds"):
        framed(spark, b"\x09aa", framing="length", width=1, max_size=3)


def test_server_sent_events(spark):
    text = ": hi\r\nevent: add\r\ndata: 1\r\ndata:  2\r\nid: 7\r\n\r\n\r\nevent: empty\n\ndata\n\ndata: cut"
    got = X.parse_sse(spark.createDataFrame([(text,)], "value string")).orderBy("event_index").collect()
    assert [(r.data, r.event, r.id) for r in got] == [("1\n 2", "add", "7"), ("", None, None)]


def test_calendar(spark):
    text = "\r\n".join(["BEGIN:VCALENDAR", "BEGIN:VEVENT", "UID:1", "SUMMARY:A long", "  title\\, two\\nlines", "DTSTART;TZID=Europe/Berlin:20240110T090000",
                        "DTEND:20240110T100000Z", "LAST-MODIFIED:20240102T000000Z", "CATEGORIES:x,y", 'ATTENDEE;CN="Doe: J";ROLE=CHAIR:mailto:j@x.org', "END:VEVENT",
                        "BEGIN:VEVENT", "UID:2", "DTSTART;VALUE=DATE:20230101", "END:VEVENT", "END:VCALENDAR"])
    events = X.parse_ics(spark.createDataFrame([(text,)], "value string"))
    one = events.where("uid = '1'").first()
    assert one.summary == "A long title, two\nlines" and one.start == datetime(2024, 1, 10, 9) and one.start_timezone == "Europe/Berlin"
    assert one.categories == "x,y" and one.attendees[0].name == "Doe: J" and one.attendees[0].email == "mailto:j@x.org"
    assert one.event_key == "1_20240110090000" and events.where("uid = '2'").first().all_day
    now = datetime(2024, 1, 1)
    assert [r.uid for r in X.window_events(events, now).collect()] == ["1"]
    assert X.window_events(events, now, include_past=True).count() == 2
    assert X.window_events(events, now, seen=events.where("uid = '1'")).count() == 0
    assert X.window_events(events, now, include_past=True, since=one.stamp_ms).count() == 1


def test_generated_records(spark):
    make = lambda **o: [(r.key, r.value) for r in Gen.generate(spark, 5, "k${sequence}", '${random_int}/${uuid}/${random_string}', **o).orderBy("offset").collect()]
    assert make(seed=1) == make(seed=1) != make(seed=2)
    assert [bytes(k) for k, _ in make(start=3, step=2)] == [b"k3", b"k5", b"k7", b"k9", b"k11"]
    assert Gen.generate(spark, 1, "", "x").first().key is None


def test_cursor_modes(spark):
    df = spark.createDataFrame([(i, datetime(2024, 1, 1 + i // 2)) for i in range(6)], "id int, ts timestamp_ntz")
    ids = lambda d: [r.id for r in d.collect()]
    day = datetime(2024, 1, 2)
    assert ids(C.incremental(df, ts_col="ts", id_col="id", last=day, last_id=2, limit=2)) == [3, 4]
    assert ids(C.incremental(df, "timestamp", ts_col="ts", id_col="id", last=day)) == [4, 5]
    assert ids(C.incremental(df, "inclusive", ts_col="ts", id_col="id", last=day, seen=df.where("id = 2"), limit=9)) == [3, 4, 5]
    assert ids(C.incremental(df, "keyset", cols=["ts", "id"], last=[day, 3], limit=1)) == [4]
    assert C.mark(df, "ts", "id").first().mark.id == 5
    assert ids(C.query(df, "id:gte:4")) == [4, 5] and C.query(df, "id:like:4").count() == 6
    assert [C.literal(t) for t in ("1", "1.5", "true", "x")] == [1, 1.5, True, "x"]
    with pytest.raises(ValueError):
        C.incremental(df, "other")


def test_recent_from_offset(spark):
    df = spark.createDataFrame([("t", 0, i) for i in range(10)], "topic string, partition int, offset long")
    assert sorted(r.offset for r in C.recent(df, 5, 6, 2).collect()) == [6, 7]
    assert C.recent(df, 5, 100).count() == 0


def test_topics(spark):
    names = ["orders", "users.events", "__consumer_offsets", "dc1.heartbeats", "dc1.checkpoints.internal"]
    df = spark.createDataFrame([(n,) for n in names], "topic string")
    assert [r.topic for r in M.select_topics(df).collect()] == ["orders", "users.events"]
    assert [r.topic for r in M.select_topics(df, allow=["orders"]).collect()] == ["orders"]
    assert [r.topic for r in M.select_topics(df, deny=["orders"], pattern="s").collect()] == ["users.events"]
    more = spark.createDataFrame([("dc1.orders",), ("users.events",), ("orders",), ("dc2.x",), ("a.b.c",), (".x",)], "topic string")
    got = {r.topic: (r.remote, r.original, r.upstream, r.loop) for r in M.remote_topic(more, "dc1", "dc2").collect()}
    assert got["dc1.orders"] == ("dc1.orders", "orders", ["dc1"], False)
    assert got["users.events"][0] == "users.events" and got["orders"] == ("dc1.orders", "orders", [], False)
    assert got["dc2.x"][3] and got["a.b.c"][2] == ["a", "b"] and got[".x"] == ("dc1..x", ".x", [], False)


def test_points_and_graph(spark):
    df = spark.createDataFrame([("cpu", "h1", 5, 1.5, True, None, 1_700_000_000)], "m string, host string, i long, d double, ok boolean, none string, at long")
    got = P.to_points(df, measurement_field="m", tags=["host"], ts_col="at", precision="s").orderBy("field").collect()
    assert [(r.field, r.double_value, r.bool_value, r.long_value) for r in got] == [("d", 1.5, None, None), ("i", None, None, 5), ("ok", None, True, None)]
    assert got[0].measurement == "cpu" and got[0].tags == {"host": "h1"} and got[0].ts.year == 2023
    edges = spark.createDataFrame([("v1", "v2", 2026), (None, "v2", 1), ("v1", "", 1), ("v1", "v9", 1)], "from string, to string, since int")
    nodes = spark.createDataFrame([("v1",), ("v2",)], "id string")
    assert G.build_edges(edges, "from", "to", "knows").count() == 2
    assert [(r["from"], r.properties) for r in G.build_edges(edges, "from", "to", "knows", nodes).collect()] == [("v1", {"since": "2026"})]


def test_versioned_table_skips_replays(spark, tmp_path):
    schema = T.StructType.fromDDL("id int, name string, n int")
    table = B.VersionedTable(spark, f"{tmp_path}/t")
    for batch in (0, 1, 1):
        table.apply(target(spark).withColumns({"offset": F.lit(batch), "n": F.lit(batch)}), "upsert", ["id"], ["offset"], schema, batch)
    assert table._last().version == 2 and {r.n for r in table.read().collect()} == {1}


def test_jdbc_statements():
    assert B.merge_statement("t", "s", ["id", "a"], ["id"], "upsert") == (
        "MERGE INTO t t USING s s ON t.id = s.id WHEN MATCHED THEN UPDATE SET a = s.a WHEN NOT MATCHED THEN INSERT (id, a) VALUES (s.id, s.a)")
    assert "NOT MATCHED" not in B.merge_statement("t", "s", ["id", "a"], ["id"], "update")
    assert B.merge_statement("t", "s", ["id"], ["id"], "delete").endswith("DELETE")
    with pytest.raises(ValueError):
        jdbc.read_jdbc(None, "jdbc:x", "t", "select 1")


def test_script_stream_resumes(spark, tmp_path):
    script.register_script(spark, "ticks", lambda tick: iter([(tick, f"v{tick}")]), "tick int, v string")
    assert sorted(r.tick for r in spark.read.format("ticks").option("partitions", 3).load().collect()) == [0, 1, 2]
    got = []

    def keep(batch, _):
        got.extend(r.tick for r in batch.collect())

    stream = spark.readStream.format("ticks").option("ticks", 2).load()
    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/c").start()
    query.processAllAvailable()
    query.stop()
    assert got == [0, 1]


def test_archived_after_commit(spark, tmp_path):
    source = spark.range(3).selectExpr("cast(id as string) value")
    for part in range(3):
        source.coalesce(1).write.mode("append").text(f"{tmp_path}/in")
    stream = I.stream_files(spark, "text", f"{tmp_path}/in", None, 1, "archive", f"{tmp_path}/done")
    for _ in range(2):
        Q.run_available(stream, f"{tmp_path}/out", f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 9
    with pytest.raises(ValueError):
        I.stream_files(spark, "text", "x", None, after="burn")


def test_timed_batches(spark, tmp_path):
    spark.range(7).selectExpr("'t' topic", "0 partition", "id offset", "cast(id as string) value").write.parquet(f"{tmp_path}/in")
    stream = I.stream_files(spark, "parquet", f"{tmp_path}/in", "topic string, partition int, offset long, value string")
    query = Q.timed_batches(stream, max_messages=3, max_age_ms=500).writeStream.format("memory").queryName("timed").option(
        "checkpointLocation", f"{tmp_path}/c").trigger(processingTime="200 milliseconds").start()
    try:
        wait = datetime.now() + timedelta(seconds=40)
        while spark.table("timed").count() < 3 and datetime.now() < wait:
            query.awaitTermination(0.5)
    finally:
        query.stop()
    got = [(r.first_offset, r.value) for r in spark.table("timed").orderBy("first_offset").collect()]
    assert got == [(0, "[0,1,2]"), (3, "[3,4,5]"), (6, "[6]")]


def test_timed_batches_close_by_age_while_records_keep_coming(spark, tmp_path):
    for i in range(8):
        spark.range(i, i + 1).coalesce(1).selectExpr("'t' topic", "0 partition", "id offset", "cast(id as string) value").write.mode(
            "append").parquet(f"{tmp_path}/in")
    stream = I.stream_files(spark, "parquet", f"{tmp_path}/in", "topic string, partition int, offset long, value string", max_files=1)
    query = Q.timed_batches(stream, max_messages=100, max_age_ms=600).writeStream.format("memory").queryName("trickle").option(
        "checkpointLocation", f"{tmp_path}/c").trigger(processingTime="400 milliseconds").start()
    try:
        wait = datetime.now() + timedelta(seconds=60)
        while sum(r.message_count for r in spark.table("trickle").collect()) < 8 and datetime.now() < wait:
            query.awaitTermination(0.5)
    finally:
        query.stop()
    counts = [r.message_count for r in spark.table("trickle").collect()]
    assert sum(counts) == 8 and max(counts) < 8


def test_heartbeat_stream(spark):
    assert Q.heartbeats(spark, "a", "b").isStreaming
    assert Gen.generate(spark, value="${sequence}", rate=1).isStreaming


def _stream_parts(spark, tmp_path, parts):
    """A stream that reads one of the parts, lists of (topic, offset, key, value), per micro-batch."""
    names = "topic string, partition int, offset long, key binary, value binary, timestamp timestamp"
    for rows in parts:
        made = [(topic, 0, at, key, value, datetime(2024, 1, 1)) for topic, at, key, value in rows]
        spark.createDataFrame(made, names).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return I.stream_files(spark, "parquet", f"{tmp_path}/in", names, max_files=1)


def test_stream_batches_in_all_rules_and_bounded_memory(spark, tmp_path, monkeypatch):
    """A backlog far beyond what a task sorts in memory, and batches that span micro-batches, equal a walk over all records."""
    monkeypatch.setattr(Q, "SORTED", 50)
    monkeypatch.setattr(Q, "PIECE", 7)
    rng = random.Random(2)
    rows = [("hot", i, rng.choice([b"a", b"b", None]) if i % 40 > 30 else b"a", b"v" * rng.randint(1, 12)) for i in range(700)]
    rows += [("cold", i, b"k", b"w") for i in range(5)]
    parts = [[r for r in rows if low <= r[1] < high] for low, high in ((0, 3), (3, 430), (430, 700))]
    parts = [rng.sample(p, len(p)) for p in parts]
    build = lambda stream: Q.stream_batches(stream, "raw", "concat", ",", max_messages=8, max_bytes=60, flush_on_key_change=True)
    Q.run_available(build(_stream_parts(spark, tmp_path, parts)), f"{tmp_path}/out", f"{tmp_path}/c", state_partitions=2)
    got = {(r.topic, r.first_offset): (bytes(r.key).decode() if r.key is not None else None, bytes(r.value).decode(), r.message_count, r.total_bytes)
           for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = {}
    for topic in ("hot", "cold"):
        held, size, last = [], 0, None
        close = lambda: want.update({(topic, held[0][1]): (
            ",".join(k.decode() for _, _, k, _ in held if k is not None) or None, ",".join(v.decode() for *_, v in held), len(held), size)})
        for row in sorted(r for r in rows if r[0] == topic) if topic == "cold" else sorted((r for r in rows if r[0] == topic), key=lambda r: r[1]):
            own = len(row[2] or b"") + len(row[3])
            if held and (size + own > 60 or (None not in (last, row[2]) and last != row[2])):
                close()
                held, size = [], 0
            held.append(row)
            size, last = size + own, row[2]
            if len(held) == 8:
                close()
                held, size = [], 0
    assert got == want


def test_stream_changes_beyond_memory(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "SORTED", 40)
    monkeypatch.setattr(Q, "PIECE", 9)
    rng = random.Random(4)
    rows = [("t", i, None, rng.choice([b"x", b"y"])) for i in range(500)]
    stream = _stream_parts(spark, tmp_path, [rng.sample(rows[:300], 300), rng.sample(rows[300:], 200)])
    Q.run_available(Q.on_change_stream(stream, ["topic"], "offset", ["value"]), f"{tmp_path}/out", f"{tmp_path}/c", state_partitions=1)
    got = sorted(r.offset for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [i for i in range(500) if i == 0 or rows[i][3] != rows[i - 1][3]]


@pytest.mark.parametrize("size", ["64b", "1000b", "8m"])
def test_large_csv_equals_whole_file_parse(spark, tmp_path, size):
    rng = random.Random(9)
    for name, header in (("a", "id,text,note"), ("b", "id,note")):
        lines = [header]
        for i in range(120):
            text = "".join(rng.choice(["x", "é", '""', "\n", "\r\n", ",", " ", "line"]) for _ in range(rng.choice([0, 3, 40, 200])))
            lines.append(f'{i},"{text}",plain {i}' if name == "a" else f'{i},"{text}"')
            lines += [""] if rng.random() < 0.1 else []
        (tmp_path / f"{name}.csv").write_bytes("\n".join(lines).encode() + (b"\n" if name == "a" else b""))
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    for name in names:
        spark.conf.set(name, size)
    try:
        got = L.read_large_csv(spark, [str(tmp_path)]).select("id", "text", "note", "source_file").collect()
        tasks = L._lines(spark, [str(tmp_path)]).rdd.getNumPartitions()
    finally:
        for name in names:
            spark.conf.unset(name)
    want = I.read_csv(spark, str(tmp_path)).select("id", "text", "note", "source_file").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str) and len(got) == 240
    assert size != "64b" or tasks > 100


def test_large_csv_cases(spark, tmp_path):
    (tmp_path / "bare.csv").write_bytes('Ä;"x;y"\n\nB;25\n'.encode("latin-1"))
    bare = L.read_large_csv(spark, [f"{tmp_path}/bare.csv"], delimiter=";", header=False, encoding="iso-8859-1")
    assert sorted(tuple(r)[:2] for r in bare.collect()) == [("B", "25"), ("Ä", "x;y")] and bare.columns == ["field_0", "field_1", "source_file"]
    blank = L.read_large_csv(spark, [f"{tmp_path}/bare.csv"], delimiter=";", header=False, encoding="iso-8859-1", skip_blank=False)
    assert sorted(map(str, (r.field_0 for r in blank.collect()))) == ["B", "None", "Ä"]
    (tmp_path / "open.csv").write_text('id,text\n1,"never\nended\n')
    assert [(r.id, r.text.rstrip()) for r in L.read_large_csv(spark, [f"{tmp_path}/open.csv"]).collect()] == [("1", "never\nended")]
    (tmp_path / "empty.csv").write_text("")
    assert L.read_large_csv(spark, [f"{tmp_path}/empty.csv"]).count() == 0


def test_bucketed_table_rewrites_what_it_touches(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, v string, offset long").schema
    path = f"{tmp_path}/t"
    table = B.BucketedTable(spark, path, ["id"], schema, 16)
    frame = lambda rows: spark.createDataFrame(rows, schema)
    written = lambda: sum(f.stat().st_size for f in tmp_path.rglob("b*/**/*.parquet"))
    table.apply(frame([(i, "a" * 50, 0) for i in range(4000)]), "upsert", order=["offset"], batch=0, writer="w")
    first = written()
    table.apply(frame([(7, "new", 1), (7, "newer", 2)]), "upsert", order=["offset"], batch=1, writer="w")
    assert written() - first < first / 8
    table.apply(frame([(7, "again", 9)]), "upsert", order=["offset"], batch=1, writer="w")  # a replay
    table.apply(frame([(5, None, 3), (None, "x", 4)]), "delete")
    table.apply(frame([(9000, "z", 5), (8, "twice", 6)]), "insert")
    got = {(r.id, r.v) for r in table.read().collect()}
    assert got == {(i, "a" * 50) for i in range(4000) if i not in (5, 7)} | {(7, "newer"), (9000, "z"), (8, "twice")}
    with pytest.raises(RuntimeError):
        B.BucketedTable.commit(table, spark.createDataFrame([(0, "b0")], B.BucketedTable._MANIFEST), after=1)
    before = written()
    assert table.expire(1) and written() < before and {(r.id, r.v) for r in table.read().collect()} == got
    assert table.applied(1, "w") and not table.applied(2, "w")
    with pytest.raises(ValueError):
        table.apply(frame([]), "upsert", ["v"])
    assert B.BucketedTable(spark, f"{tmp_path}/none", ["id"], schema).read() is None


def test_large_csv_is_cut_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"x\ny"\n2,z\n3,"""\n"\n')
    found = L.read_large_csv(spark, [str(tmp_path)])
    # every step after the cut reads stored records
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.text) for r in found.collect()) == [("1", "x\ny"), ("2", "z"), ("3", '"\n')]
