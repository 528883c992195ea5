"""Every registered query against its SQL check, on the smallest tables."""

import oracle
import pytest

from rivulet.plans import CHECKS, QUERIES


@pytest.fixture(scope="module")
def db(data):
    return oracle.connect(data)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, data, db, name):
    assert oracle.compare(spark, db, data, QUERIES[name], CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_runs_over_whole_table(spark, data, name):
    rows = QUERIES[name](spark, data)
    documents = spark.read.parquet(f"{data}/documents.parquet").where("length(trim(text)) > 0")
    assert rows.select("doc_id").distinct().count() == documents.count()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["group", "operation", "result", "count", "window_end"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
