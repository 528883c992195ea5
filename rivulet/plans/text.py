"""Registered queries: chunking."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import chunking as K
from rivulet.plans.inputs import documents, table
from rivulet.plans.registry import query

_SPACES = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '||chr(133)||chr(160)||chr(8232)||chr(8233)||chr(12288)"
_OUT = ["doc_id", "chunk", "chunk_index", "chunk_total", "start_offset", "end_offset"]


def _docs(spark, sf):
    return documents(spark, sf, "doc_id", "text")


def _numbered(source):
    """Drop empty chunks and number the rest, as SQL over (doc_id, start, stop, chunk)."""
    return f"""SELECT doc_id, chunk, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS INTEGER) AS chunk_index,
  CAST(count(*) OVER (PARTITION BY doc_id) AS INTEGER) AS chunk_total, CAST(start AS INTEGER) AS start_offset, CAST(stop AS INTEGER) AS end_offset
FROM {source} WHERE chunk <> ''"""


@query("chunk_chars", f"""WITH w AS (SELECT doc_id, text, unnest(range(0, length(text), 800)) AS start FROM documents),
c AS (SELECT doc_id, start, least(start + 1000, length(text)) AS stop, trim(substr(text, start + 1, 1000), {_SPACES}) AS chunk FROM w)
{_numbered('c')}""")
def chunk_chars(spark, sf):
    return K.chunk(_docs(spark, sf)).select(*_OUT)


@query("chunk_words", f"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '\\s*[^\\s]+') AS spaced FROM documents),
s AS (SELECT *, list_transform(spaced, lambda x: ltrim(x, {_SPACES})) AS words FROM t),
w AS (SELECT *, unnest(range(1, len(spaced) + 1, 80)) AS i FROM s),
c AS (SELECT doc_id, array_to_string(words[i : i + 99], ' ') AS chunk,
  length(array_to_string(spaced[1 : i], '')) - length(words[i]) AS start,
  length(array_to_string(spaced[1 : least(i + 99, len(spaced))], '')) AS stop FROM w)
{_numbered('c')}""")
def chunk_words(spark, sf):
    return K.chunk(_docs(spark, sf), size=100, overlap=20, unit="words").select(*_OUT)


@query("chunk_metadata", f"""WITH d AS (SELECT conv_id, turn, role, text FROM conversations),
w AS (SELECT *, unnest(range(0, length(text), 150)) AS start FROM d),
c AS (SELECT *, least(start + 200, length(text)) AS stop, trim(substr(text, start + 1, 200), {_SPACES}) AS chunk FROM w),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY start) - 1 AS i, count(*) OVER (PARTITION BY conv_id, turn) AS n
  FROM c WHERE chunk <> '')
SELECT conv_id, chunk, i || '/' || n || '@' || start || '-' || stop || ' of ' || role || ':0:' || turn AS note FROM n""")
def chunk_metadata(spark, sf):
    rows = table(spark, sf, "conversations").select(
        "conv_id", F.col("role").alias("topic"), F.lit(0).alias("partition"), F.col("turn").alias("offset"), "text",
        F.create_map(F.lit("source"), F.lit(b"chat")).alias("headers"))
    out = K.chunk(rows, size=200, overlap=50, metadata=True)
    h = {n: F.col("headers")[f"chunk_{n}"].cast("string") for n in
         ("index", "total", "start_offset", "end_offset", "original_topic", "original_partition", "original_offset")}
    note = F.concat(h["index"], F.lit("/"), h["total"], F.lit("@"), h["start_offset"], F.lit("-"), h["end_offset"], F.lit(" of "),
                    h["original_topic"], F.lit(":"), h["original_partition"], F.lit(":"), h["original_offset"])
    return out.select("conv_id", "chunk", note.alias("note"))


def _pack_sql(pieces, size, joiner):
    """Greedy packing without overlap as a fold: each piece opens a chunk or joins the open one."""
    return f"""WITH p AS ({pieces}),
l AS (SELECT doc_id, list(struct_pack(t := t, a := a, b := b) ORDER BY a) AS ps FROM p WHERE t <> '' GROUP BY doc_id),
f AS (SELECT doc_id, ps, list_reduce(list_transform(ps, lambda x: struct_pack(cuts := [CAST(0 AS BIGINT)], filled := len(x.t), n := CAST(1 AS BIGINT))),
    lambda s, x: CASE WHEN s.filled + x.filled > {size} THEN struct_pack(cuts := list_append(s.cuts, s.n), filled := x.filled, n := s.n + 1)
                      ELSE struct_pack(cuts := s.cuts, filled := s.filled + x.filled, n := s.n + 1) END) AS s FROM l),
c AS (SELECT doc_id, ps, unnest(s.cuts) AS i, unnest(list_append(s.cuts[2:], s.n)) AS j FROM f),
o AS (SELECT doc_id, ps[i + 1].a AS start, ps[j].b AS stop,
  array_to_string(list_transform(ps[i + 1 : j], lambda x: x.t), {joiner}) AS chunk FROM c)
{_numbered('o')}"""


_SENTENCES = f"""SELECT doc_id, trim(piece, {_SPACES}) AS t, upto - length(piece) AS a, upto AS b FROM (
  SELECT doc_id, piece, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM (
    SELECT doc_id, unnest(m) AS piece, generate_subscripts(m, 1) AS i FROM (
      SELECT doc_id, regexp_extract_all(text, '[^.!?]*[.!?]\\s*|[^.!?]+') AS m FROM documents)))"""
_PARAGRAPHS = f"""SELECT doc_id, trim(piece, {_SPACES}) AS t, upto - length(piece) - 1 AS a, upto - 1 AS b FROM (
  SELECT doc_id, piece, sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM (
    SELECT doc_id, unnest(m) AS piece, generate_subscripts(m, 1) AS i FROM (
      SELECT doc_id, string_split(text, chr(10)) AS m FROM documents)))"""


@query("chunk_sentences", _pack_sql(_SENTENCES, 500, "' '"))
def chunk_sentences(spark, sf):
    return K.chunk(_docs(spark, sf), strategy="sentence", size=500, overlap=0).select(*_OUT)


@query("chunk_paragraphs", _pack_sql(_PARAGRAPHS, 800, "chr(10)"))
def chunk_paragraphs(spark, sf):
    return K.chunk(_docs(spark, sf), strategy="paragraph", size=800, overlap=0, separator="\n").select(*_OUT)


@query("chunk_recursive")
def chunk_recursive(spark, sf):
    return K.chunk(_docs(spark, sf), strategy="recursive", size=500, overlap=50, compat=True).select(*_OUT)
