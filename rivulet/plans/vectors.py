"""Registered queries: vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import vectors as V
from rivulet.plans.inputs import table
from rivulet.plans.registry import query


def _records(spark, sf):
    """Every vector as a record; records of one label delete their predecessor's id, some carry no id of their own."""
    rows = table(spark, sf, "embeddings")
    return rows.select(
        F.lit("vectors").alias("topic"), F.lit(0).alias("partition"), F.col("vec_id").alias("offset"),
        F.concat(F.lit("k"), F.floor(F.col("vec_id") / 2)).alias("key"),
        F.when(F.col("label") != 3, F.concat(F.lit('{"embedding":'), F.to_json("embedding"), F.lit(',"content":"c'), "label",
                                             F.lit('","metadata":{"label":"'), "label", F.lit('"}}'))).alias("value"),
        F.lit(None).cast("timestamp").alias("timestamp"))


@query("vector_upsert", """WITH l AS (SELECT vec_id // 2 AS k, max_by(vec_id, vec_id) AS vec_id, arg_max(label, vec_id) AS label,
  arg_max(embedding, vec_id)::DOUBLE[] AS e FROM embeddings GROUP BY 1)
SELECT 'k' || k AS id, 'c' || label AS content, CAST(label AS VARCHAR) AS label, len(e) AS size,
  round(e[1] / sqrt(list_dot_product(e, e)), 5) AS first, round(e[len(e)] / sqrt(list_dot_product(e, e)), 5) AS last FROM l WHERE label <> 3""")
def vector_upsert(spark, sf):
    out = V.upsert_vectors(_records(spark, sf))
    e = F.col("embedding")
    return out.select("id", "content", F.col("metadata")["label"].alias("label"), F.size(e).cast("long").alias("size"),
                      F.round(F.element_at(e, 1), 5).alias("first"), F.round(F.element_at(e, -1), 5).alias("last"))


def _centres(spark, sf):
    """One query per label: the mean of its vectors."""
    parts = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.round(F.avg("x"), 6).alias("x"))
    return means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("m")).select(
        F.col("label").alias("query_id"), F.transform("m", lambda p: p["x"]).alias("query"))


_CENTRES = """parts AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
means AS (SELECT label, i, round(avg(x), 6) AS x FROM parts GROUP BY 1, 2),
queries AS (SELECT label AS query_id, list(x ORDER BY i) AS q FROM means GROUP BY 1),
v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings)"""


def _topk_sql(score, keep, order, k):
    return f"""WITH {_CENTRES}, s AS (SELECT query_id, id, round({score}, 12) AS score FROM queries, v)
SELECT query_id, id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, id) AS rank FROM s WHERE {keep}) WHERE rank <= {k}"""


@query("vector_topk", _topk_sql("list_cosine_similarity(q, e)", "score >= 0.1", "DESC", 20))
def vector_topk(spark, sf):
    vectors = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "id")
    return V.topk(vectors, _centres(spark, sf), k=20, min_similarity=0.1).withColumn("score", F.round("score", 6))


@query("vector_metrics", f"""WITH {_CENTRES},
s AS (SELECT query_id, id, round(list_dot_product(q, e), 12) AS dot, round(list_distance(q, e), 9) AS euclid FROM queries, v),
d AS (SELECT 'dot' AS metric, query_id, id, dot AS score, row_number() OVER (PARTITION BY query_id ORDER BY dot DESC, id) AS rank FROM s WHERE dot >= 0),
e AS (SELECT 'euclid' AS metric, query_id, id, euclid AS score, row_number() OVER (PARTITION BY query_id ORDER BY euclid, id) AS rank FROM s)
SELECT metric, query_id, id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (SELECT * FROM d UNION ALL SELECT * FROM e) WHERE rank <= 10""")
def vector_metrics(spark, sf):
    vectors, queries = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "id"), _centres(spark, sf)
    found = [V.topk(vectors, queries, k=10, metric=m).withColumn("metric", F.lit(m)).withColumn("score", F.round("score", 6)) for m in ("dot", "euclid")]
    return found[0].unionByName(found[1])


@query("vector_responses", f"""WITH {_CENTRES},
l AS (SELECT vec_id // 2 AS k, arg_max(label, vec_id) AS label, arg_max(embedding, vec_id)::DOUBLE[] AS e FROM embeddings GROUP BY 1),
s AS (SELECT query_id, 'k' || k AS id, label, round(list_cosine_similarity(q, l.e), 12) AS score FROM queries, l WHERE label <> 3),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s WHERE score >= 0.1)
SELECT query_id, CAST(rank AS INTEGER) AS rank, id, round(score, 6) AS score, 'c' || label AS content,
  '{{"label":"' || label || '"}}' AS metadata FROM r WHERE rank <= 5""")
def vector_responses(spark, sf):
    vectors = V.upsert_vectors(_records(spark, sf))
    found = V.responses(V.topk(vectors, _centres(spark, sf), k=5, min_similarity=0.1), vectors)
    return found.select("query_id", F.inline("results")).withColumn("score", F.round("score", 6))


@query("query_vector_parse", """SELECT CAST(vec_id AS VARCHAR) AS query_id, len(embedding) AS size, round(embedding[2]::DOUBLE, 4) AS second
FROM embeddings WHERE label <> 4""")
def query_vector_parse(spark, sf):
    text = F.to_json("embedding")
    shapes = {0: text, 1: F.concat(F.lit('{"embedding":'), text, F.lit("}")), 2: F.concat(F.lit(' {"query":'), text, F.lit("}")),
              4: F.lit('{"query":[1,"x"]}')}
    value = F.coalesce(*[F.when(F.col("label") == label, shape) for label, shape in shapes.items()], shapes[1])
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("key"), value.alias("value"))
    out = V.parse_queries(rows)
    return out.select("query_id", F.size("query").cast("long").alias("size"), F.round(F.element_at("query", 2), 4).alias("second"))
