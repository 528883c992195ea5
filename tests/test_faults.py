"""Cases that the given tables cannot show."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from rivulet.operators import aggregation as A, enrichment, routing as R, vectors as V
from rivulet.plans.inputs import spread
from rivulet.sinks import files as S
from rivulet.sinks.tables import VersionedTable
from rivulet.sources import files, incremental as I


def test_csv_files_with_their_own_headers(spark, tmp_path):
    for name, text in {"a": "id,name\n1,x\n", "b": "\nname,id\ny,2\n", "c": "id,name,extra\n3,z,e\n", "d d": "id,name\n4,w\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    got = files.read_csv(spark, str(tmp_path)).select("id", "name", "extra").collect()
    assert sorted(map(tuple, got), key=str) == [("1", "x", None), ("2", "y", None), ("3", "z", "e"), ("4", "w", None)]


def test_batches_of_two_writers(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    schema = spark.createDataFrame([], "id long, v string, offset long").schema
    for writer, id_ in (("q1", 1), ("q2", 2), ("q1", 3)):
        table.apply(spark.createDataFrame([(id_, writer, id_)], schema), "upsert", ["id"], ["offset"], schema, 0, writer)
    assert sorted(r["id"] for r in table.read().collect()) == [1, 2]


def test_near_ties_rank_by_score(spark):
    vectors = spark.createDataFrame([(1, [1.0, 1e-4]), (2, [1.0, 0.0]), (3, [0.6 - 3e-7, 0.8])], "id long, embedding array<double>")
    asked = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, query array<double>")
    got = V.topk(vectors, asked, k=3, min_similarity=0.6).orderBy("rank").collect()
    assert [r["id"] for r in got] == [2, 1]


def test_seen_rows_that_moved_past_the_mark(spark):
    rows = spark.createDataFrame([(1, 12), (2, 10), (3, 10)], "id long, ts long")
    seen = spark.createDataFrame([(1, 10), (2, 10)], "id long, ts long")
    got = I.incremental(rows, "inclusive", ts_col="ts", id_col="id", last=10, seen=seen).collect()
    assert sorted(r["id"] for r in got) == [1, 3]


def test_predicates_of_another_kind(spark):
    rows = spark.createDataFrame([(1, "x", True), (2, "5", False)], "n long, s string, b boolean")
    count = lambda where: I.query(rows, where).count()
    assert (count("s:eq:5"), count("s:eq:x"), count("n:gte:2"), count("n:eq:x"), count("b:eq:true"), count("n:lt:1.5")) == (0, 1, 1, 0, 1, 1)
    assert I.literal("1_000") == "1_000" and I.literal("nan") == "nan" and I.literal("1e3") == 1000.0


def test_lines_trim_all_white_space(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('\t{"a":1}\t\n\t\n {"a":2}\n')
    assert [r["value"] for r in files.read_jsonl(spark, str(tmp_path)).collect()] == ['{"a":1}', '{"a":2}']


def test_an_empty_frame_is_an_empty_array(spark, tmp_path):
    S.write_json(spark.createDataFrame([], "a long"), str(tmp_path / "j"), lines=False)
    assert [r["value"] for r in spark.read.text(str(tmp_path / "j")).collect()] == ["[]"]


def test_whole_numbers_and_nulls_reach_user_code(spark):
    rows = spark.createDataFrame([(1, None), (2**60 + 1, 5)], "a long, b long").coalesce(1)
    got = R.flat_map(rows, lambda r: iter([{"seen": repr((r["a"], r["b"])), "a": r["a"]}]), "seen string, a long, c int").collect()
    assert {tuple(r) for r in got} == {("(1, None)", 1, None), (f"({2**60 + 1}, 5)", 2**60 + 1, None)}
    tagged = R.guarded(rows.withColumn("key", F.lit(b"k")).withColumn("value", F.lit(b"v")), lambda r: iter([{"x": 1 // (r["b"] - 5)}]), "x int", "deadletter")
    assert {r["error_type"] for r in tagged.collect()} == {"TypeError", "ZeroDivisionError"}


def test_enriched_values_are_json(spark):
    rows = spark.createDataFrame([("t", 1, None, "k", '{"a":1}'), ("t", None, 7, "k", "no")], "topic string, partition int, offset long, key string, value string")
    got = enrichment.enrich(rows.coalesce(1), lambda: lambda texts: [{"n": len(t)} for t in texts]).collect()
    strict = [json.loads(r["value"], parse_constant=lambda c: 1 / 0) for r in got]
    assert {(x["_metadata"]["partition"], x["_metadata"]["offset"]) for x in strict} == {(1, None), (None, 7)}
    assert all("1.0" not in r["value"] for r in got)


def test_ledger_takes_whole_amounts_once(spark):
    rows = [("a", "x", "y", "12"), ("a", "x", "y", "12"), ("b", "x", "y", "12.7"), ("c", "x", "y", "-5"), ("d", "x", "y", "zz"), (None, "x", "y", "1"), ("e", "y", "x", "3")]
    transfers = spark.createDataFrame(rows, "id string, debit_account_id string, credit_account_id string, amount string")
    got = {r["account"]: (int(r["debits_posted"]), int(r["credits_posted"]), r["legs"]) for r in A.balances(transfers).collect()}
    assert got == {"x": (12, 3, 2), "y": (3, 12, 2)}
    reasons = {r["id"]: r["reason"] for r in A.invalid_transfers(transfers).collect()}
    assert reasons == {"b": "amount not whole", "c": "amount negative", "d": "amount not whole", None: "id missing"}


def test_maps_exchange_nothing(spark, data):
    from rivulet.plans import QUERIES

    for name in ("filter", "if_route", "map"):
        assert "Exchange" not in QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()


def test_many_tasks_are_left_alone(spark):
    assert spread(spark.range(0, 100, 1, 64)).rdd.getNumPartitions() == 64


def test_if_route_verdicts(spark):
    rows = spark.createDataFrame([("a", '{"v":1}'), ("b", '{"v":-1}'), ("c", "{}")], "topic string, value string").withColumn("at", F.lit(datetime(2024, 1, 1)))
    test = F.get_json_object("value", "$.v").cast("int") > 0
    route = lambda **k: {r["value"]: r["topic"] for r in R.if_route(rows, test, "yes", **k).collect()}
    assert route() == {'{"v":1}': "yes"}
    assert route(false_topic="no") == {'{"v":1}': "yes", '{"v":-1}': "no"}
    assert route(errors=True) == {'{"v":1}': "yes", "{}": None}
    assert route(false_topic="no", errors=True) == {'{"v":1}': "yes", '{"v":-1}': "no", "{}": None}
