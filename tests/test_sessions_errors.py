"""Session windows, ids that several transfers share, the error channel, filters on odd columns and cursors from the same pass."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rivulet.operators import aggregation as A, errors as E
from rivulet.sources import files as I, incremental as C
from rivulet.streaming import queries as Q

START = datetime(2024, 1, 1)


def visits(spark, n=400, seed=3):
    """One user with most of the visits, equal times, and pauses of exactly the gap."""
    rng = random.Random(seed)
    rows, clock = [], {}
    for _ in range(n):
        user = "hot" if rng.random() < 0.7 else rng.choice("abc")
        clock[user] = clock.get(user, START) + timedelta(seconds=rng.choice([0, 1, 30, 59, 60, 61, 300]))
        rows.append((f'{{"user":"{user}","n":{rng.randint(1, 9)}}}', clock[user]))
    rows.append(('{"user":"a","n":5}', None))
    return spark.createDataFrame(rng.sample(rows, len(rows)), "value string, timestamp timestamp")


@pytest.mark.parametrize("ranges", [1, 25])
def test_sessions_equal_sparks_own(spark, ranges):
    df = visits(spark)
    got = A.finish(A.session_partials(df, "60 seconds", "n", "user", ranges=ranges), "sum")
    user, n = F.get_json_object("value", "$.user"), F.get_json_object("value", "$.n").cast("double")
    want = df.groupBy(user.alias("group"), F.session_window("timestamp", "60 seconds").alias("s")).agg(F.sum(n).alias("result"), F.count("*").alias("count"))
    want = want.select("group", F.lit("sum").alias("operation"), "result", "count", "s.start", "s.end")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 40


def test_stream_sessions_take_late_records_until_the_watermark(spark, tmp_path):
    at = lambda *seconds: [('{"u":"x"}', START + timedelta(seconds=s)) for s in seconds]
    # 95 comes late and joins two sessions; 5 comes after the watermark has passed its session
    for rows in (at(0, 10, 60, 130), at(95, 400), at(900), at(5, 1300)):
        spark.createDataFrame(rows, "value string, timestamp timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = I.stream_files(spark, "parquet", f"{tmp_path}/in", "value string, timestamp timestamp", max_files=1)
    out = A.aggregate(stream, "count", group_by="u", session="40 seconds", watermark="100 seconds")
    Q.run_available(out, f"{tmp_path}/out", f"{tmp_path}/c")
    got = sorted((int((r["window_start"] - START).total_seconds()), r["count"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(0, 2), (60, 3), (400, 1), (900, 1)]


def test_first_transfer_of_an_id_posts(spark):
    rows = [("a", 3, "x", "y", "12"), ("a", 1, "x", "y", "50"), ("a", 2, "x", "y", "50"), ("a", 1, "x", "y", "50"),
            ("b", 9, "y", "x", "7"), ("b", 9, "y", "x", "6"), ("c", 4, "x", "z", "-1"), (None, 5, "x", "z", "1"), ("d", 6, "z", "x", "2")]
    transfers = spark.createDataFrame(rows, "id string, offset long, debit_account_id string, credit_account_id string, amount string")
    got = {r["account"]: (int(r["debits_posted"]), int(r["credits_posted"]), r["legs"]) for r in A.balances(transfers, order=["offset"]).collect()}
    assert got == {"x": (50, 8, 3), "y": (6, 50, 2), "z": (2, 0, 1)}
    reasons = sorted((str(r["id"]), r["offset"], r["reason"]) for r in A.invalid_transfers(transfers, ["offset"]).collect())
    assert reasons == [("None", 5, "id missing"), ("a", 3, "id taken by another transfer"), ("b", 9, "id taken by another transfer"), ("c", 4, "amount negative")]
    plan = A.balances(transfers, order=["offset"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def channel(spark):
    rows = [("t", 1, "no json"), ("t", 2, '{"v":5}'), ("t", 3, '{"v":50}'), ("t", 4, "{}"), ("t", 5, None), ("t", 6, '{"v":70,"m":"x"}'), ("t", 7, '{"v":80,"m":"y"}')]
    df = spark.createDataFrame(rows, "topic string, offset long, value string").withColumn("headers", F.create_map(F.lit("h"), F.lit("1").cast("binary")))
    v, m = F.try_variant_get(F.col("json"), "$.v", "int"), F.try_variant_get(F.col("json"), "$.m", "string")
    kept = E.filter_checked(E.checked(df), v > 10)
    return E.map_checked(E.route_checked(kept, v > 75, "high", "low"), F.when(v != 50, m))


def test_failed_records_pass_through_every_step(spark):
    out = E.settled(channel(spark), topic="dead")
    got = {r.offset: (r.topic, r.value, r.error, bytes(r.headers["topic"]).decode() if "topic" in r.headers else None) for r in out.collect()}
    assert got == {
        1: ("dead", "no json", "payload is not JSON", "t"), 4: ("dead", "{}", "condition cannot be decided", "t"),
        5: ("dead", None, "payload is not JSON", "t"), 3: ("dead", '{"v":50}', "value cannot be made", "low"),
        6: ("low", "x", None, None), 7: ("high", "y", None, None)}
    assert str(out._jdf.queryExecution().executedPlan()).count("Scan ExistingRDD") == 1
    assert sorted(r.offset for r in E.settled(channel(spark), "skip").collect()) == [6, 7]
    with pytest.raises(PySparkException, match="record failed"):
        E.settled(channel(spark), "fail").collect()
    with pytest.raises(ValueError):
        E.settled(channel(spark), "shrug")


def test_filters_on_nested_and_cased_columns_and_large_numbers(spark):
    df = spark.sql("SELECT 5L AS name, named_struct('T', '5', 'n', 7) AS s, array(1) AS list, 1.5D AS d, cast(5 AS decimal(38,0)) AS big, 'x' AS `a.b`")
    matches = lambda text: C.query(df, text).count() == 1
    assert matches("NAME:eq:5") and matches("s.t:eq:x") is False and matches("S.N:gte:7") and not matches("s.t:eq:5")
    assert not matches("name:gt:99999999999999999999") and matches("name:lt:99999999999999999999") and matches("big:lt:" + "9" * 45)
    assert matches("d:lt:" + "9" * 45) and not matches("missing:eq:1") and not matches("s.missing:eq:1") and not matches("s:eq:1") and not matches("list:eq:1")
    assert matches("a.b:eq:x")


def test_cursor_of_the_rows_written(spark, tmp_path):
    """Rows that come into the table between the write and the cursor are read the next time."""
    table, out, store = f"{tmp_path}/t", f"{tmp_path}/out", f"{tmp_path}/marks"
    spark.range(0, 50).write.parquet(table)

    def write(rows):
        rows.write.mode("append").parquet(out)
        spark.range(50, 80).write.mode("append").parquet(table)  # another writer, before the cursor is known

    pending = C.incremental(spark.read.parquet(table), "incrementing", id_col="id")
    assert C.write_marked(pending, write, store, "t", "id") == 49
    assert spark.read.parquet(store).first().mark == 49
    later = C.incremental(spark.read.parquet(table), "incrementing", id_col="id", last_id=49)
    assert C.write_marked(later, lambda rows: rows.write.mode("append").parquet(out), store, "t", "id") == 79
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(80))
    passing, _ = C.observed(pending, "id")
    assert str(passing._jdf.queryExecution().executedPlan()).count("FileScan") == 1
