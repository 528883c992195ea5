"""Small cases for record operators: routing, aggregation, batching, keyed state."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from rivulet.operators import aggregation as A, batching as B, keyed as K, routing as R
from rivulet.records import RECORD


def records(spark, values, keys=None, topics=None):
    rows = [
        (topics[i] if topics else "in", 0, i, bytearray((keys[i] if keys else "k").encode()) if not keys or keys[i] is not None else None,
         None if v is None else bytearray(v.encode()), datetime(2024, 1, 1, 0, 0, i % 60), {})
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, RECORD)


def values(df):
    return [bytes(r.value).decode() for r in df.orderBy("offset").collect()]


def grouped(df):
    return {r.group: (r.result, r["count"]) for r in df.collect()}


def test_count_by_field(spark):
    rows = records(spark, ['{"depot":"kiel"}', '{"depot":"bern"}', '{"depot":"kiel"}'])
    assert grouped(A.aggregate(rows, "count", group_by="depot")) == {"kiel": (2.0, 2), "bern": (1.0, 1)}


def test_no_records_no_groups(spark):
    assert A.aggregate(records(spark, []), "count").count() == 0


@pytest.mark.parametrize("op,expected", [("sum", 15.5), ("avg", 7.75), ("min", 3.0), ("max", 12.5), ("other", 2.0)])
def test_operations(spark, op, expected):
    rows = records(spark, ['{"weight":12.5}', '{"weight":3}'])
    assert grouped(A.aggregate(rows, op, "weight")) == {"_all": (expected, 2)}


def test_nested_group_and_average_over_all_records(spark):
    assert grouped(A.aggregate(records(spark, ['{"ship":{"flag":"no"}}']), "count", group_by="ship.flag")) == {"no": (1.0, 1)}
    rows = records(spark, ['{"weight":8}', '{"weight":"x"}', "{}"])
    assert grouped(A.aggregate(rows, "avg", "weight")) == {"_all": (8 / 3, 3)}
    assert grouped(A.aggregate(records(spark, ['{"weight":"7"}', '{"weight":"7d"}']), "sum", "weight")) == {"_all": (7.0, 2)}


def test_missing_and_broken_groups(spark):
    rows = records(spark, ["{}", "not json", "", '{"depot":null}', '{"depot":79.0}'])
    assert grouped(A.aggregate(rows, "count", group_by="depot")) == {"_null": (2.0, 2), "_all": (2.0, 2), "79.0": (1.0, 1)}


def test_no_numbers_have_no_extremes(spark):
    assert grouped(A.aggregate(records(spark, ["{}"]), "min", "weight")) == {"_all": (None, 1)}


def test_switch(spark):
    rows = records(spark, ['{"grade":"hot"}', '{"grade":"HOT"}', '{"grade":"mild"}', '{"grade":5}', "{}", "broken"])
    routed = R.switch_route(rows, "grade", "hot:first,5:x,Hot:ovens", "rest")
    assert [r.topic for r in routed.orderBy("offset").collect()] == ["ovens", "ovens", "rest", "rest", "rest", "rest"]
    assert R.switch_route(rows, "grade", {"hot": "ovens"}).count() == 2
    nested = records(spark, ['{"lab":{"test":"iron"}}'])
    assert R.switch_route(nested, "lab.test", {"iron": "metals"}).first().topic == "metals"


def test_if_route(spark):
    rows = records(spark, ['{"v":1}', '{"v":5}', "broken"])
    test = "try_variant_get(json, '$.v', 'int') > 3"
    assert [r.topic for r in R.if_route(rows, test, "high", "low").orderBy("offset").collect()] == ["low", "high"]
    assert [r.topic for r in R.if_route(rows, test, "high").collect()] == ["high"]
    assert [r.topic for r in R.if_route(rows, test, "high", "low", errors=True).orderBy("offset").collect()] == ["low", "high", None]


def test_map_encodes(spark):
    rows = records(spark, ['{"v":1}'])
    assert values(R.map_records(rows, "null")) == [""]
    assert values(R.map_records(rows, "named_struct('a', 1, 'b', array(2))")) == ['{"a":1,"b":[2]}']
    assert values(R.map_records(rows, "1.5D")) == ["1.5"]
    assert values(R.map_records(rows, "json")) == ['{"v":1}']


@pytest.mark.parametrize("value,path,expected", [
    ('[{"pos":4},{"pos":5},{"pos":6}]', ".", ['{"pos":4}', '{"pos":5}', '{"pos":6}']),
    ('{"crate":{"eggs":[{"pos":1},{"pos":9}]}}', "crate.eggs", ['{"pos":1}', '{"pos":9}']),
    ('{"pos":8}', ".", ['{"pos":8}']),
    ("[null]", ".", ["null"]),
    ("[]", ".", []),
    ("oops [", ".", ["oops ["]),
    ('["a",2,true]', ".", ['"a"', "2", "true"]),
])
def test_split(spark, value, path, expected):
    assert values(R.split(records(spark, [value]), path)) == expected


def test_split_index(spark):
    rows = R.split(records(spark, ['["a","b"]', "{}"]), ".", include_index=True).collect()
    assert sorted((bytes(r.headers["_index"]).decode() if r.headers else None) or "-" for r in rows) == ["-", "0", "1"]


def test_merge_keeps_source(spark):
    rows = records(spark, ['{"seen":1}'] * 2, topics=["a", "b"])
    merged = R.merge([rows, rows], "all", add_source=True)
    assert {(r.topic, r._source_topic) for r in merged.collect()} == {("all", "a"), ("all", "b")}
    assert "_source_topic" not in R.merge([rows, rows]).columns


def test_error_policies(spark):
    rows = records(spark, ["1", "x"]).select("key", "value")

    def number(r):
        yield {"n": int(r["value"])}

    assert [r.n for r in R.guarded(rows, number, "n long", "skip").collect()] == [1]
    good, dead = R.dead_letters(R.guarded(rows, number, "n long", "deadletter"))
    assert [r.n for r in good.collect()] == [1]
    failure = dead.first()
    assert (bytes(failure.original_value), failure.error_type) == (b"x", "ValueError")
    with pytest.raises(Exception, match="invalid literal"):
        R.guarded(rows, number, "n long", "fail").collect()


def test_for_each_runs_on_executors(spark):
    seen = spark.sparkContext.accumulator(0)
    R.for_each(spark.range(10), lambda r: seen.add(r["id"]))
    assert seen.value == 45


def fnv(data):
    h = 2166136261
    for b in data:
        h = (h ^ b) * 16777619 % 2**32
    return h


def test_partition_assignment(spark):
    rows = records(spark, ["{}"] * 4, keys=["a", "täst", "", None])
    got = [r.partition for r in R.assign_partition(rows, 7).orderBy("offset").collect()]
    assert got == [fnv(b"a") % 7, fnv("täst".encode()) % 7, 2, 3]


def test_partition_key_choices(spark):
    rows = records(spark, ['{"id":"f"}', "{}", "{}", "{}"], keys=["k", '{"u":7,"v":8}', "plain", None])
    got = [r.partition_key for r in R.partition_key(rows, "id").orderBy("offset").collect()]
    assert got == ["f", "7", "plain", "in-0-3"]


def test_stable_ids(spark):
    import hashlib
    import uuid

    rows = records(spark, ['{"id":"name"}', '{"id":42}', '{"id":"6BA7B810-9DAD-11D1-80B4-00C04FD430C8"}'])
    got = [r.id for r in R.stable_id(rows, "field", "id").orderBy("offset").collect()]
    digest = hashlib.sha256(b"name").digest()[:16]
    assert got == [str(uuid.UUID(bytes_le=digest)), "42", "6ba7b810-9dad-11d1-80b4-00c04fd430c8"]


def test_render(spark):
    rows = records(spark, ['{"name":"n","count":3,"deep":{"x":"y"}}'])
    text = R.render(rows, "${topic}/${name}/${count}/${deep.x}/${key}/${nope}!").first().text
    assert text == "in/n//y/k/!"


def test_batches_by_bytes(spark):
    rows = records(spark, ["x" * 30] * 2, keys=[None, None])
    assert sorted(r.message_count for r in B.batch(rows, max_bytes=50, format="raw").collect()) == [1, 1]
    assert [r.message_count for r in B.batch(rows, max_bytes=60, format="raw").collect()] == [2]


def test_batches_by_key_change(spark):
    rows = records(spark, [f'{{"id":{i}}}' for i in range(5)], keys=["a", "b", None, "c", "c"])
    got = B.batch(rows, flush_on_key_change=True).orderBy("batch_start").collect()
    assert [r.message_count for r in got] == [1, 4]  # a null key neither closes a batch nor lets the next one


def test_batch_formats(spark):
    rows = records(spark, ['{"id":1}', "plain", None], keys=["a", None, "c"])

    def made(**options):
        r = B.batch(rows, **options).first()
        return (None if r.key is None else bytes(r.key).decode()), bytes(r.value).decode()

    assert made() == ("a", '[{"id":1},"cGxhaW4="]')
    assert made(format="json-lines", key_strategy="last", separator=";") == ("c", '{"id":1};"cGxhaW4=";')
    assert made(format="raw", key_strategy="concat", separator="|") == ("a|c", '{"id":1}|plain|')
    assert made(key_strategy="null")[0] is None
    entry = json.loads(made(include_metadata=True)[1])
    assert entry[0] == {"topic": "in", "partition": 0, "offset": 0, "key": "YQ==", "value": {"id": 1}, "timestamp": "2024-01-01T00:00:00.0000000+00:00"}
    assert entry[2]["value"] is None


def test_latest_and_history(spark):
    rows = records(spark, ["1", "2", None, "4"], keys=["a", "a", "b", "c"])
    assert {(bytes(r.key).decode(), r.revision) for r in K.latest(rows).collect()} == {("a", 1), ("c", 3)}
    assert K.latest(rows, keep_deleted=True).where("operation = 'Delete'").count() == 1
    assert K.latest(rows, history=True).count() == 4


def test_on_change_first_observation(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(["a", "a", "b", None, None, "b"])], "k int, at long, v string")
    assert [r.at for r in K.on_change(df, ["k"], "at", ["v"]).orderBy("at").collect()] == [0, 2, 3, 5]
    assert [r.at for r in K.on_change(df, ["k"], "at", ["v"], emit_first=False).orderBy("at").collect()] == [2, 3, 5]


def test_dedupe_against_emitted(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    emitted = spark.createDataFrame([(2,)], "id int")
    assert [(r.id, r.v) for r in K.dedupe(df, ["id"], ["v"], emitted).collect()] == [(1, "a")]


def test_ledger(spark):
    schema = T.StructType().add("id", "string").add("debit_account_id", "string").add("credit_account_id", "string").add("amount", "string").add("ledger", "integer")
    moves = spark.createDataFrame([("1", "2", "3", "1000", 700), ("2", "3", "2", "1", 700), ("3", None, "2", "5", 700), ("4", "2", "3", "1" + "0" * 39, 700)], schema)
    got = {(r.account, r.ledger): (r.debits_posted, r.credits_posted) for r in A.balances(moves.where("id < '4'")).collect()}
    assert got == {("2", 700): (1000, 1), ("3", 700): (1, 1000)}
    assert {r.id: r.reason for r in A.invalid_transfers(moves).collect()} == {"3": "debit_account_id missing", "4": "amount out of range"}
    accounts = spark.createDataFrame([("2", 700), ("9", 700), (None, 700)], "id string, ledger int")
    own = {r.account: (r.code, r.debits_posted, r.legs) for r in A.balances(moves.where("id < '4'"), accounts).collect()}
    assert own == {"2": (1, 1000, 2), "9": (1, 0, 0)}


def test_metrics_and_errors(spark):
    m = A.replication_metrics(records(spark, ["abc", None], keys=["k", "kk"])).first()
    assert (m.records, m.bytes, m.last_offset) == (2, 6, 1)
    errors = spark.createDataFrame([("a",), (None,), ("a",)], "error_type string")
    assert [(r.error_type, r.errors) for r in A.error_counts(errors).collect()] == [("a", 2)]


def test_merged_partials_equal_whole(spark):
    rows = records(spark, [f'{{"v":{i}}}' for i in range(10)])
    halves = [A.partials(rows.where(F.col("offset") % 2 == p), "v") for p in (0, 1)]
    assert grouped(A.finish(A.merge_partials(*halves), "avg")) == grouped(A.aggregate(rows, "avg", "v"))
