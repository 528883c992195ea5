"""The registered queries of this package, each over its whole table, and the SQL checks that exist."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm import (
    bpe, collocations, html_text, infill, kdtree, lattice, licences, line_dedup, mixing, quality, secrets, simhash, weighted,
)
from rivulet.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return add


def tokenizer_text(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return bpe.vocabulary_text(public_tokenizers.path(name))


@query("op1_bpe")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    content = tokenizer_text()
    coded = bpe.decode(bpe.encode(read(spark, folder, "documents", "doc_id", "text"), content).drop("text"), content)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query("op2_licences")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(read(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", F.size("licences").alias("n_licences"), "licences")


#: Means are per document; fixed-width shares of one digest serve Spark and SQL alike.
MIX_SQL = f"""WITH s AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, n, 1.0::DOUBLE / (SELECT count(*) FROM s) * (SELECT sum(n) FROM s) / n AS rate FROM s),
d AS (SELECT *, greatest(1, ceil(rate / {mixing.STEP}))::INT AS draws FROM r),
k AS (SELECT d.source, d.draws, rate / draws AS mean, t.k FROM d, range(0, 85) t(k)),
p AS (SELECT source, draws, k, sum(exp(k * ln(mean) - mean - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS reach FROM k),
u AS (SELECT doc_id, documents.source, i, ('0x' || substr(md5(concat_ws('|', '17', doc_id::VARCHAR, i::VARCHAR)), 1, {mixing.DIGITS}))::BIGINT
        / pow(16::DOUBLE, {mixing.DIGITS}) AS u
      FROM documents JOIN d ON documents.source IS NOT DISTINCT FROM d.source, unnest(range(1, d.draws + 1)) x(i)),
c AS (SELECT doc_id, count(p.k) AS copies FROM u JOIN p ON u.source IS NOT DISTINCT FROM p.source AND p.reach <= u.u GROUP BY doc_id, u.source)
SELECT documents.doc_id, documents.source, n_chars, md5(text) AS text_md5, x.copy::INT AS copy
FROM documents JOIN c USING (doc_id), unnest(range(1, c.copies + 1)) x(copy)"""


@query("op3_mix", MIX_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents"))
    return mixed.select("doc_id", "source", "n_chars", F.md5("text").alias("text_md5"), "copy")


@query("op4_quality")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(read(spark, folder, "documents", "doc_id", "text")).select("doc_id", "quality", "accepted")


@query("op5_line_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(read(spark, folder, "documents", "doc_id", "text"))


@query("op6_main_text")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract(read(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op7_secrets")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(read(spark, folder, "documents", "doc_id", "text"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("found", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(secrets.written(base), 256).alias("base_sha256"), secrets.written(F.col("found")).alias("spans"),
    )


NEAREST_SQL = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM (SELECT DISTINCT * FROM v) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS "rank" FROM s)
SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 10"""


@query("op8_top_k", NEAREST_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings").select("vec_id", kdtree.whole_numbers(F.col("embedding")).alias("v"))
    queries = vectors.where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"), "v")
    return kdtree.top_k(vectors, queries, k=10)


@query("op9_simhash")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents", "doc_id", "text"), shingle=3, distance=2)


@query("op10_lattice")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(read(spark, folder, "embeddings", "vec_id", "embedding"))


#: The cuts follow from digests; texts come back from their new form, so their digest is that of the text.
INFILL_SQL = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
c AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
  ('0x' || substr(h, 17, 8))::BIGINT % 100 AS c, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS d FROM d),
f AS (SELECT doc_id, t, n, least(a, b) AS x, greatest(a, b) AS y,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain' WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form FROM c),
p AS (SELECT *, substr(t, 1, x) AS pre, substr(t, x + 1, y - x) AS mid, substr(t, y + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars, CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p"""


@query("op11_infill", INFILL_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    cut = infill.transform(read(spark, folder, "documents", "doc_id", "text").select("doc_id", "text"))
    return cut.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restored(), 256).alias("restored_sha256"),
    )


@query("op12_fingerprints")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return weighted.along(read(spark, folder, "documents", "doc_id", "text"))


COLLOCATIONS_SQL = r"""WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM t),
o AS (SELECT lang, unnest(ws) AS w1, unnest(ws[2:]) AS w2, unnest(ws[3:]) AS w3 FROM w),
u AS (SELECT lang, w1, count(*) AS f FROM o WHERE w1 IS NOT NULL GROUP BY ALL),
b AS (SELECT lang, w1, w2, count(*) AS f FROM o WHERE w2 IS NOT NULL GROUP BY ALL),
c AS (SELECT lang, w1, w2, w3, count(*) AS f FROM o WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM u GROUP BY lang),
longer AS (SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM c UNION ALL SELECT lang, w2, w3, f FROM c) GROUP BY ALL),
two AS (SELECT b.lang, b.w1 || ' ' || b.w2 AS phrase, b.f AS a, x.f AS l, y.f AS r, 1 AS k FROM b JOIN u x ON x.lang = b.lang AND x.w1 = b.w1
  JOIN u y ON y.lang = b.lang AND y.w1 = b.w2 LEFT JOIN longer g ON g.lang = b.lang AND g.w1 = b.w1 AND g.w2 = b.w2
  WHERE b.f >= 10 AND 100 * coalesce(g.f, 0) < 50 * b.f),
three AS (SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3 AS phrase, c.f AS a, x.f AS l, y.f AS r, 1 AS k FROM c
    JOIN u x ON x.lang = c.lang AND x.w1 = c.w1 JOIN b y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
  UNION ALL SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, x.f, y.f, 2 FROM c
    JOIN b x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2 JOIN u y ON y.lang = c.lang AND y.w1 = c.w3),
s AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM (FROM two UNION ALL FROM three)),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS "rank" FROM best)
SELECT lang, "rank", phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE "rank" <= 2000"""


@query("op13_collocations", COLLOCATIONS_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read(spark, folder, "documents", "lang", "text"))
