"""Results must not depend on how groups are cut, and match brute force on skewed data."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from rivulet.operators import batching as B, cdc as C, keyed as K, ordered as O, replication as M, vectors as V, writes as W


def skewed(spark, n=600, seed=1):
    """One key holds most rows; others have a few."""
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("abcdef"), i * 3, rng.choice([None, "x", "y"]), rng.randint(1, 9)) for i in range(n)]
    return spark.createDataFrame(rows, "k string, at long, v string, n int").repartition(7)


@pytest.mark.parametrize("ranges", [1, 40])
def test_scan_equals_window(spark, ranges):
    df = skewed(spark).withColumns({"share": F.col("n") / 4, "cost": F.col("n").cast("decimal(9,2)"), "pair": F.struct("v", "n")})
    got = O.scan(df, ["k"], ["at"], running={"total": F.col("n"), "shares": F.col("share"), "costs": F.col("cost")},
                 previous={"before": F.col("v"), "pair_before": F.col("pair")}, latest={"known": F.col("v")},
                 following={"ahead": F.col("v")}, highest={"peak": F.when(F.col("n") > 2, F.col("n"))}, runs={"run": F.col("v")}, ranges=ranges)
    w = Window.partitionBy("k").orderBy("at")
    upto, onward = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    rows = df.withColumns({"number": F.row_number().over(w), "changed": F.coalesce(F.lag("v").over(w) != F.col("v"), F.lit(False))})
    want = rows.select(*df.columns, F.sum("n").over(upto).alias("total"), F.sum("share").over(upto).alias("shares"), F.sum("cost").over(upto).alias("costs"),
                       F.lag("v").over(w).alias("before"), F.lag("pair").over(w).alias("pair_before"),
                       F.last("v", ignorenulls=True).over(upto).alias("known"), F.first("v", ignorenulls=True).over(onward).alias("ahead"),
                       F.max(F.when(F.col("n") > 2, F.col("n"))).over(upto).alias("peak"),
                       F.max(F.when(F.col("changed") | (F.col("number") == 1), F.col("number"))).over(upto).cast("long").alias("run"))
    assert [f.dataType for f in got.select(want.columns).schema] == [f.dataType for f in want.schema]
    assert sorted(got.select(want.columns).collect(), key=str) == sorted(want.collect(), key=str)


def test_null_group(spark):
    df = spark.createDataFrame([(None, i) for i in range(10)], "k string, at long")
    assert sorted(r.n for r in O.numbered(df, ["k"], ["at"], ranges=4).collect()) == list(range(1, 11))
    assert O.numbered(df.limit(0), ["k"], ["at"]).count() == 0
    assert sorted(r.n for r in O.numbered(df, [], ["at"], ranges=4).collect()) == list(range(1, 11))


def test_scan_moves_its_input_once(spark):
    """Positions far apart make no more summary rows than there are ranges, and both steps read one exchange."""
    df = spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") * 10_000_000).alias("at"))
    got = O.numbered(df, ["k"], ["at"], ranges=8)
    assert got.where("n <> at / 10000000 + 1").count() == 0
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # a reused exchange is written out once more where it is reused
    assert plan.count("ReusedExchange") == 1 and plan.count("Exchange rangepartitioning(") == 2


def test_quantile_cuts_balance(spark):
    df = spark.createDataFrame([("hot", f"t{i:05d}", i) for i in range(2000)], "k string, t string, at long")
    sizes = [r["count"] for r in df.groupBy(O.by_quantiles(df, ["t", "at"], 8).alias("s")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 400


@pytest.mark.parametrize("n", [3, 1500])
def test_top_per_group(spark, n):
    df = skewed(spark, 4000)
    got = O.top_per_group(df, ["k"], [F.desc("at")], n)
    w = Window.partitionBy("k").orderBy(F.desc("at"))
    want = df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    assert sorted(got.select(want.columns).collect(), key=str) == sorted(want.collect(), key=str)


def test_top_per_group_with_nested_maps(spark):
    df = skewed(spark, 3000).withColumn("s", F.struct(F.create_map("k", "n").alias("m"), F.array(F.create_map("k", "at")).alias("a")))
    got = O.top_per_group(df, ["k"], [F.desc("at")], 1200)
    sizes = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    assert {r["k"]: r["count"] for r in got.groupBy("k").count().collect()} == {k: min(n, 1200) for k, n in sizes.items()}
    assert got.where("k = 'hot'").agg(F.max("rank"), F.countDistinct("at")).first() == (1200, 1200)


def test_patching_a_table_is_no_full_outer_join(spark):
    table = spark.createDataFrame([(1, 10), (2, None), (None, 5)], "id long, value long")
    deltas = spark.createDataFrame([(2, 3), (2, 4), (9, 1), (None, 2)], "id long, value long")
    got = W.increment(table, deltas, ["id"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 10), (2, 7), (None, 5), (9, 1), (None, 2)], key=str)
    part = spark.createDataFrame([(1, 7, 0), (4, 8, 1)], "id long, value long, offset long")
    wide = table.withColumn("note", F.lit("n"))
    merged = W.upsert(wide, part, ["id"], ["offset"])
    assert sorted(map(tuple, merged.collect()), key=str) == sorted([(1, 7, "n"), (2, None, "n"), (None, 5, "n"), (4, 8, None)], key=str)
    for made in (got, merged):
        assert "FullOuter" not in made._jdf.queryExecution().optimizedPlan().toString()


def greedy(rows, max_messages, max_bytes, max_age, on_key):
    starts, count, size, opened, last, clock = [], 0, 0, None, None, None
    for i, (key, value, ts) in enumerate(rows, start=1):
        clock = ts if clock is None else max(clock, ts)
        own = len(key or b"") + len(value)
        changed = on_key and last is not None and key is not None and key != last
        if count and (count >= max_messages or changed or (max_bytes and size + own > max_bytes) or (max_age and clock - opened >= max_age)):
            count, size = 0, 0
        if count == 0:
            start, opened = i, clock
        starts.append(start)
        count, size, last = count + 1, size + own, key
    return starts


@pytest.mark.parametrize("max_bytes,max_age,on_key", [(40, None, False), (40, "20 seconds", True), (None, "9 seconds", False), (None, None, True), (7, None, True)])
@pytest.mark.parametrize("block", [1, 30])
def test_batches_match_a_walk(spark, max_bytes, max_age, on_key, block):
    rng = random.Random(5)
    base, rows = datetime(2024, 1, 1), []
    for partition, n in (("hot", 500), ("cold", 40), ("one", 1)):
        for i in range(n):
            rows.append((partition, i * 2, rng.choice([b"a", b"bb", None]), b"v" * rng.randint(1, 15), base + timedelta(seconds=i + rng.randint(-3, 3))))
    df = spark.createDataFrame(rows, "topic string, offset long, key binary, value binary, timestamp timestamp").repartition(5)
    got = B.assign_batches(df, max_messages=6, max_bytes=max_bytes, max_age=max_age, flush_on_key_change=on_key,
                           partition_by=["topic"], ranges=block)
    age = timedelta(seconds=int(max_age.split()[0])) if max_age else None
    for partition in ("hot", "cold", "one"):
        own = sorted((r for r in rows if r[0] == partition), key=lambda r: r[1])
        want = greedy([(k, v, t) for _, _, k, v, t in own], 6, max_bytes, age, on_key)
        found = [r.batch_start for r in got.where(F.col("topic") == partition).orderBy("offset").collect()]
        assert found == want, partition


def test_many_ranges(spark):
    df = spark.range(900).select(F.lit("t").alias("topic"), F.col("id").alias("offset"), F.lit(None).cast("binary").alias("key"),
                                 F.repeat(F.lit("v"), (F.col("id") % 11 + 1).cast("int")).cast("binary").alias("value"), F.current_timestamp().alias("timestamp"))
    got = B.assign_batches(df, max_messages=5, max_bytes=24, partition_by=["topic"], ranges=50).orderBy("offset").collect()
    rows = [(None, b"v" * (i % 11 + 1), i) for i in range(900)]
    assert [r.batch_start for r in got] == greedy(rows, 5, 24, None, False)


@pytest.mark.parametrize("size", [1, 10, 40])
def test_batches_without_a_message_cap(spark, size):
    """Batches longer than a range, and sizes that never let chains of batches meet."""
    df = spark.range(700).select(F.lit("t").alias("topic"), F.col("id").alias("offset"), F.lit(None).cast("binary").alias("key"),
                                 F.repeat(F.lit("v"), F.lit(size)).cast("binary").alias("value"), F.current_timestamp().alias("timestamp"))
    got = B.assign_batches(df, max_messages=None, max_bytes=370, partition_by=["topic"], ranges=30).orderBy("offset").collect()
    rows = [(None, b"v" * size, i) for i in range(700)]
    assert [r.batch_start for r in got] == greedy(rows, 1 << 40, 370, None, False)


def test_changes_with_many_ranges(spark):
    df = skewed(spark)
    one = K.on_change(df, ["k"], "at", ["v"])
    many = K.on_change(df, ["k"], "at", ["v"], ranges=60)
    assert sorted(one.collect(), key=str) == sorted(many.collect(), key=str)


def translated(offset, marks):
    if not marks:
        return None
    if offset in marks:
        return marks[offset]
    below, above = [s for s in marks if s < offset], [s for s in marks if s > offset]
    if not below:
        return marks[min(above)]
    if not above:
        return marks[max(below)] + offset - max(below)
    lo, hi = max(below), min(above)
    return marks[lo] + int((offset - lo) / (hi - lo) * (marks[hi] - marks[lo]))


def test_translation_matches_brute_force(spark):
    rng = random.Random(3)
    marks = {p: {s: s * 2 // 3 - rng.randint(0, 3) for s in rng.sample(range(1000), n)} for p, n in ((0, 60), (1, 1))}
    rows = [("dc", "t", p, s, t) for p, m in marks.items() for s, t in m.items()]
    mappings = spark.createDataFrame(rows, "cluster string, topic string, partition int, source_offset long, target_offset long")
    offsets = spark.createDataFrame([("dc", "t", p, o) for p in (0, 1, 2) for o in range(-5, 1010, 7)], "cluster string, topic string, partition int, offset long")
    for ranges in (1, 40):
        for r in M.translate(offsets, mappings, ranges=ranges).collect():
            assert r.target_offset == translated(r.offset, marks.get(r.partition, {})), r


@pytest.mark.parametrize("pairs,at,want", [([(100, 95), (200, 195), (300, 295)], 200, 195), ([(100, 95), (200, 195)], 50, 95),
                                            ([(100, 100), (200, 200)], 150, 150), ([(100, 100), (200, 200)], 250, 250)])
def test_translation_cases(spark, pairs, at, want):
    mappings = spark.createDataFrame([("c", "t", 0, s, t) for s, t in pairs], "cluster string, topic string, partition int, source_offset long, target_offset long")
    offsets = spark.createDataFrame([("c", "t", 0, at)], "cluster string, topic string, partition int, offset long")
    assert M.translate(offsets, mappings).first().target_offset == want
    kept = M.translate(offsets, mappings, keep=1).first().target_offset
    last = max(pairs)
    assert kept == (last[1] + at - last[0] if at > last[0] else last[1])


def vectors(spark, rows):
    return spark.createDataFrame(rows, "id string, embedding array<float>")


def queries(spark, rows):
    return spark.createDataFrame(rows, "query_id string, query array<double>")


def hits(df):
    return [(r.query_id, r.id, round(r.score, 4)) for r in df.orderBy("query_id", "rank").collect()]


def test_topk_cases(spark):
    v = vectors(spark, [("far", [0.0, 1.0, 0.0]), ("close", [0.9, 0.1, 0.0]), ("exact", [1.0, 0.0, 0.0])])
    q = queries(spark, [("q", [1.0, 0.0, 0.0])])
    assert hits(V.topk(v, q, 3)) == [("q", "exact", 1.0), ("q", "close", 0.9939), ("q", "far", 0.0)]
    assert hits(V.topk(v, q, 3, min_similarity=0.5)) == [("q", "exact", 1.0), ("q", "close", 0.9939)]
    assert hits(V.topk(v, q, 0)) == []
    assert hits(V.topk(v, queries(spark, [("q", [1.0, 0.0])]), 1)) == [("q", "close", 0.0)]
    assert hits(V.topk(v, q, 2, metric="euclid")) == [("q", "exact", 0.0), ("q", "close", 0.1414)]
    nested = V.responses(V.topk(v, q, 2)).first()
    assert [r.id for r in nested.results] == ["exact", "close"]


def test_blocked_search_equals_direct(spark, monkeypatch):
    monkeypatch.setattr(V, "ROWS_PER_SLICE", 40)
    rng = random.Random(9)
    v = vectors(spark, [(f"v{i:03d}", [rng.uniform(-1, 1) for _ in range(8)]) for i in range(150)] + [("zero", [0.0] * 8), ("short", [1.0])])
    q = queries(spark, [(f"q{i:02d}", [rng.uniform(-1, 1) for _ in range(8)]) for i in range(30)])
    for metric in ("cosine", "dot", "euclid"):
        assert hits(V.topk(v, q, 4, metric=metric)) == hits(V.topk(v, q, 4, metric=metric, query_numbers=64))


def test_vector_entries(spark):
    rows = [(0, "a", '{"id":"x","embedding":[3,4],"content":"c","metadata":{"n":1}}'), (1, "key-as-id", '{"embedding":[1,0]}'),
            (2, "b", '{"id":"z","embedding":[0,0]}'), (3, "b", '{"id":"bad","embedding":[1,"2"]}'), (4, None, '{"embedding":[1]}'),
            (5, "gone", '{"embedding":[1]}'), (6, "gone", None), (7, "b", "broken")]
    df = spark.createDataFrame([(o, k, v, datetime(2024, 1, 1)) for o, k, v in rows], "offset long, key string, value string, timestamp timestamp")
    got = {r.id: (r.embedding, r.content, r.metadata) for r in V.upsert_vectors(df).collect()}
    assert got == {"x": ([0.6, 0.8], "c", {"n": "1"}), "key-as-id": ([1.0, 0.0], None, None), "z": ([0.0, 0.0], None, None)}


def test_query_vectors(spark):
    rows = [("a", "[1,2.5]"), ("b", '{"embedding":[1]}'), ("c", '{"query":[2]}'), ("d", '{"embedding":"no","query":[3]}'), ("e", '{"other":[1]}'), ("f", '[1,"x"]'), ("g", "broken")]
    got = {r.query_id: r.query for r in V.parse_queries(spark.createDataFrame(rows, "key string, value string")).collect()}
    assert got == {"a": [1.0, 2.5], "b": [1.0], "c": [2.0], "d": [3.0]}


def test_apply_undoes_diff(spark):
    old = spark.createDataFrame([(i, i * 2, None if i % 3 else "x") for i in range(50)], "id int, a int, b string")
    new = old.where("id > 10").withColumn("a", F.when(F.col("id") % 2 == 0, F.col("a") + 1).otherwise(F.col("a"))).unionByName(
        spark.createDataFrame([(100, 1, None)], old.schema))
    events = C.change_events(old, new, ["id"]).withColumn("at", F.lit(1))
    assert sorted(C.apply_changes(old, events, ["id"], ["at"]).collect()) == sorted(new.collect())
    counts = {r.op: r["count"] for r in events.groupBy("op").count().collect()}
    assert counts == {"c": 1, "d": 11, "u": 19}


def test_pairs_across_segments(spark):
    log = [("t", lsn, seq, op, seq) for seq, (lsn, op) in enumerate([(1, 2), (2, 3), (2, 4), (5, 3), (6, 4), (9, 1)])]
    df = spark.createDataFrame(log, "table string, lsn long, seq long, operation int, v long")
    got = [(r.op, r.before and r.before.v, r.after and r.after.v) for r in C.pair_updates(df, ranges=5).orderBy("seq").collect()]
    assert got == [("c", None, 0), ("u", 1, 2), ("u", 3, 4), ("d", 5, None)]


def test_lsn_window_never_splits(spark):
    log = spark.createDataFrame([("a", lsn, s) for lsn in range(1, 6) for s in range(3)] + [("b", 9, 0)], "table string, lsn long, seq long")
    assert {r.lsn for r in C.lsn_window(log, None, 4).collect()} == {1, 2}
    assert {r.lsn for r in C.lsn_window(log, 3, 100).collect()} == {4, 5, 9}
