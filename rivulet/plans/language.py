"""Registered queries: text analysis and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import enrichment as N, language as L
from rivulet.plans.inputs import documents, table
from rivulet.plans.registry import query

_WS = r"\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _docs(spark, sf):
    return documents(spark, sf, "doc_id", "text")


def _list(words):
    return ", ".join(f"'{w}'" for w in words)


_WORDS = """w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda x: x <> '') AS words FROM documents)"""


@query("tokens", f"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_{_WS}]') AS tokens,
  regexp_split_to_array(text, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_{_WS}]') AS gaps FROM documents),
u AS (SELECT doc_id, unnest(tokens) AS token, unnest(gaps[:len(tokens)]) AS gap, generate_subscripts(tokens, 1) AS i FROM t),
o AS (SELECT doc_id, token, sum(length(token) + length(gap)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM u)
SELECT doc_id, count(*) AS tokens, CAST(sum(stop) AS BIGINT) AS ends, CAST(sum(stop - length(token)) AS BIGINT) AS begins, max(token) AS last FROM o GROUP BY doc_id""")
def tokens(spark, sf):
    found = L.tokenize(_docs(spark, sf))
    return found.groupBy("doc_id").agg(
        F.count("*").alias("tokens"), F.sum("end").alias("ends"), F.sum("begin").alias("begins"), F.max("token").alias("last"))


@query("sentences", f"""WITH m AS (SELECT doc_id, regexp_extract_all(text, '[^.!?]*[.!?]|[^.!?]+') AS m FROM documents),
u AS (SELECT doc_id, unnest(m) AS piece, generate_subscripts(m, 1) AS i FROM m),
o AS (SELECT doc_id, piece, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM u)
SELECT doc_id, regexp_replace(piece, '^[{_WS}]+|[{_WS}]+$', '', 'g') AS sentence,
  CAST(stop - length(regexp_replace(piece, '^[{_WS}]+', '')) AS INTEGER) AS "begin",
  CAST(stop - length(piece) + length(regexp_replace(piece, '[{_WS}]+$', '')) AS INTEGER) AS "end" FROM o
WHERE regexp_replace(piece, '[{_WS}]+', '', 'g') <> ''""")
def sentences(spark, sf):
    return L.sentences(_docs(spark, sf)).select("doc_id", "sentence", "begin", "end")


def _redacted(text, names=tuple(L.PII)):
    for name in names:
        text = f"regexp_replace({text}, '{L.PII[name]}', '[{name}]', 'g')"
    return text


@query("pii_redact", f"SELECT doc_id, {_redacted('text')} AS redacted FROM documents")
def pii_redact(spark, sf):
    return L.pii_redact(_docs(spark, sf)).select("doc_id", "redacted")


def _finds():
    """What each type finds in the text once the types before it are redacted."""
    names = list(L.PII)
    rows = [
        f"SELECT doc_id, '{name}' AS type, regexp_extract_all({_redacted('text', names[:i])}, '{L.PII[name]}') AS m FROM documents"
        for i, name in enumerate(names)
    ]
    return f"""WITH f AS ({" UNION ALL ".join(rows)})
SELECT doc_id, type, len(m) AS finds, array_to_string(m, '|') AS found, 1.0::DOUBLE AS score FROM f WHERE len(m) > 0"""


@query("pii_spans", _finds())
def pii_spans(spark, sf):
    out = L.pii_spans(_docs(spark, sf).withColumn("whole", F.col("text")))
    found = F.struct("begin", F.substring(F.col("whole"), F.col("begin") + 1, F.col("end") - F.col("begin")).alias("text"))
    return out.groupBy("doc_id", "type").agg(
        F.count("*").alias("finds"), F.array_join(F.array_sort(F.collect_list(found))["text"], "|").alias("found"), F.max("score").alias("score"))


_LANGUAGES = ",\n".join(f"CAST(len(list_filter(words, lambda x: x IN ({_list(v)}))) AS INTEGER) AS {k}_n" for k, v in L.STOP_WORDS.items())
_CANDIDATES = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS language, {k}_n AS n, de_n + en_n + es_n + fr_n AS total FROM c" for k in L.STOP_WORDS)


@query("detect_language", f"""WITH {_WORDS}, c AS (SELECT doc_id, {_LANGUAGES} FROM w), s AS ({_CANDIDATES}),
best AS (SELECT doc_id, language, round(n / total, 6) AS score FROM s WHERE n > 0
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, language) = 1)
SELECT d.doc_id, lang, language, score, language IS NOT DISTINCT FROM lang AS correct FROM documents d LEFT JOIN best USING (doc_id)""")
def detect_language(spark, sf):
    out = L.detect_language(documents(spark, sf))
    best = F.get(F.col("languages"), F.lit(0))
    return out.select("doc_id", "lang", best["language"].alias("language"), F.round(best["score"], 6).alias("score"),
                      best["language"].eqNullSafe(F.col("lang")).alias("correct"))


_MOODS = {"the": 1, "de": 1, "der": 1, "la": 1, "of": -1, "trash": -1, "und": -1, "et": -1, "en": -1}


@query("sentiment", f"""WITH {_WORDS}, c AS (SELECT doc_id, len(list_filter(words, lambda x: x IN ({_list(w for w, v in _MOODS.items() if v > 0)}))) AS good,
  len(list_filter(words, lambda x: x IN ({_list(w for w, v in _MOODS.items() if v < 0)}))) AS bad, greatest(len(words), 1) AS n FROM w)
SELECT doc_id, CASE WHEN good = 0 AND bad = 0 THEN 'NEUTRAL' WHEN good > 0 AND bad > 0 AND abs(good - bad) * 4 <= good + bad THEN 'MIXED'
  WHEN good >= bad THEN 'POSITIVE' ELSE 'NEGATIVE' END AS sentiment, round(good / n, 6) AS positive, round(bad / n, 6) AS negative FROM c""")
def sentiment(spark, sf):
    out = L.sentiment(_docs(spark, sf), _MOODS)
    return out.select("doc_id", "sentiment", F.round("positive", 6).alias("positive"), F.round("negative", 6).alias("negative"))


_TF = f"""{_WORDS}, tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM w) WHERE length(term) >= 3 GROUP BY ALL),
idf AS (SELECT term, ln((SELECT count(*) FROM documents) / count(*)) AS idf FROM tf GROUP BY term)"""


@query("key_phrases", f"""WITH {_TF}, s AS (SELECT doc_id, term, round(tf * idf, 12) AS score FROM tf JOIN idf USING (term)),
m AS (SELECT doc_id, regexp_extract_all(lower(text), '\\p{{L}}+') AS found, regexp_split_to_array(lower(text), '\\p{{L}}+') AS gaps FROM documents),
u AS (SELECT doc_id, unnest(found) AS term, unnest(gaps[:len(found)]) AS gap, generate_subscripts(found, 1) AS i FROM m),
firsts AS (SELECT doc_id, term, min(stop - length(term)) AS first FROM (
  SELECT doc_id, term, sum(length(term) + length(gap)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM u) GROUP BY ALL)
SELECT s.doc_id, term AS phrase, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY s.doc_id ORDER BY score DESC, term) AS INTEGER) AS rank,
  CAST(first AS INTEGER) AS "offset" FROM s JOIN firsts USING (doc_id, term)
QUALIFY row_number() OVER (PARTITION BY s.doc_id ORDER BY score DESC, term) <= 5""")
def key_phrases(spark, sf):
    return L.key_phrases(_docs(spark, sf)).withColumn("score", F.round("score", 6))


@query("summary_extract", f"""WITH {_TF}, m AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^.!?]*[.!?]|[^.!?]+'),
  lambda x: regexp_replace(x, '^[{_WS}]+|[{_WS}]+$', '', 'g')), lambda x: x <> '') AS m FROM documents),
u AS (SELECT doc_id, unnest(m) AS sentence, generate_subscripts(m, 1) - 1 AS i FROM m),
t AS (SELECT doc_id, i, unnest(list_filter(regexp_split_to_array(lower(sentence), '[^\\p{{L}}]+'), lambda x: x <> '')) AS term FROM u),
s AS (SELECT t.doc_id, i, round(sum(coalesce(tf * idf, 0)) / count(*), 12) AS score FROM t LEFT JOIN tf USING (doc_id, term) LEFT JOIN idf USING (term) GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS rank FROM s)
SELECT doc_id, CAST(i AS INTEGER) AS index, sentence, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM b JOIN u USING (doc_id, i) WHERE rank <= 3""")
def summary_extract(spark, sf):
    return L.summarize(_docs(spark, sf)).select("doc_id", "index", "sentence", F.round("score", 6).alias("score"), "rank")


@query("moderation", f"""WITH {_WORDS}, c AS (SELECT doc_id, len(list_filter(words, lambda x: x IN ({_list(L.RULES['harassment'][0])}))) / greatest(len(words), 1) AS h,
  len(list_filter(words, lambda x: x IN ({_list(L.RULES['violence'][0])}))) / greatest(len(words), 1) AS v FROM w)
SELECT doc_id, toxic, round(h, 6) AS harassment_score, h > 0 AS harassment_flag, h > 0 OR v > 0.01 AS flagged FROM c LEFT JOIN labels USING (doc_id)""")
def moderation(spark, sf):
    out = L.moderate(_docs(spark, sf)).join(table(spark, sf, "labels"), "doc_id", "left")
    return out.select("doc_id", "toxic", F.round("harassment_score", 6).alias("harassment_score"), "harassment_flag", "flagged")


@query("embed")
def embed(spark, sf):
    return L.embed(_docs(spark, sf), 64).select("doc_id", F.transform("embedding", lambda x: F.round(x, 5)).alias("embedding"))


def _counter():
    def count(texts):
        return [{"chars": len(t), "lines": t.count("\n") + 1} for t in texts]

    return count


@query("enrich", """SELECT conv_id AS key, length(text) AS chars, len(string_split(text, chr(10))) AS lines, role AS topic, turn AS "offset",
  role AS "from" FROM conversations""")
def enrich(spark, sf):
    rows = table(spark, sf, "conversations").select(
        F.col("role").alias("topic"), F.lit(0).alias("partition"), F.col("turn").alias("offset"), F.col("conv_id").alias("key"),
        F.to_json(F.struct("text", F.col("role").alias("from"))).alias("value"))
    out = N.enrich(rows, _counter, "text")
    at = F.get_json_object
    return out.select("key", at("value", "$.enrichment.chars").cast("long").alias("chars"), at("value", "$.enrichment.lines").cast("long").alias("lines"),
                      at("value", "$._metadata.topic").alias("topic"), at("value", "$._metadata.offset").cast("long").alias("offset"),
                      at("value", "$.from").alias("from"))
