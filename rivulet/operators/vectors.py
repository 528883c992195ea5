"""Vector entries: upsert by id, similarity search, query parsing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.operators.ordered import latest_per_key, top_per_group
from rivulet.records import as_text, json_path, kind_of, node_at, parsed

# Query vectors up to this many numbers travel with the plan; more are exchanged in blocks.
QUERY_NUMBERS = 4_000_000
ROWS_PER_SLICE = 100_000
_NUMBERS = r"^\s*\[[-+0-9.eE,\s]*\]\s*$"


def normalised(vector: Column) -> Column:
    """The vector at unit length; a zero vector stays as it is."""
    wide = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda a, x: a + x * x))
    return F.when(norm == 0, wide).otherwise(F.transform(wide, lambda x: x / norm))


def _vector_of(text: Column) -> Column:
    """A JSON array of numbers; null for anything else."""
    return F.when(text.rlike(_NUMBERS), F.from_json(text, "array<double>"))


def entries(df: DataFrame, id_field: str = "id", embedding_field: str = "embedding", content_field: str = "content") -> DataFrame:
    """Records as vector entries; a record without a value is a delete, unusable ones are left out."""
    text = as_text("value")
    json = F.col("__json")

    def string_at(name: str) -> Column:
        node = node_at(json, name)
        return F.when(kind_of(node) == "STRING", F.try_variant_get(json, json_path(name), "string"))

    staged = df.withColumn("__json", parsed())
    tombstone = F.col("value").isNull() | (F.octet_length("value") == 0)
    found = staged.select(
        *[c for c in df.columns if c in ("topic", "partition", "offset")],
        F.when(tombstone, as_text("key")).otherwise(F.coalesce(string_at(id_field), as_text("key"))).alias("id"),
        _vector_of(F.get_json_object(text, json_path(embedding_field))).alias("embedding"),
        string_at(content_field).alias("content"),
        F.from_json(F.get_json_object(text, "$.metadata"), "map<string,string>").alias("metadata"),
        F.col("timestamp").alias("ts"),
        tombstone.alias("deleted"),
    )
    return found.where(F.col("id").isNotNull() & (F.col("deleted") | F.col("embedding").isNotNull()))


def upsert_vectors(df: DataFrame, order: Sequence[str] = ("offset",), **fields) -> DataFrame:
    """The entries alive after all records: last write per id wins, embeddings at unit length."""
    last = latest_per_key(entries(df, **fields), ["id"], [F.desc(c) for c in order])
    alive = last.where(~F.col("deleted"))
    return alive.select("id", normalised(F.col("embedding")).alias("embedding"), "content", "metadata", "ts")


def parse_queries(df: DataFrame) -> DataFrame:
    """Query records as (query_id, query): a JSON array, or one under `embedding` or `query`."""
    text = as_text("value")

    def listed(path: str) -> Column:
        found = F.get_json_object(text, path)
        return F.when(found.startswith("["), found)

    root = F.when(F.ltrim(text).startswith("["), text)
    query = _vector_of(F.coalesce(root, listed("$.embedding"), listed("$.query")))
    return df.select(F.coalesce(as_text("key"), F.uuid()).alias("query_id"), query.alias("query")).where(F.col("query").isNotNull())


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(norms == 0, 1.0, norms)


#: Scores that agree to these decimals tie: what is beyond is rounding that depends on how rows are batched.
DIGITS = {"cosine": 12, "dot": 12, "euclid": 9}


def _scores(queries: np.ndarray, vectors: np.ndarray, metric: str) -> np.ndarray:
    if metric == "euclid":
        gaps = (queries * queries).sum(1)[:, None] - 2 * queries @ vectors.T + (vectors * vectors).sum(1)[None, :]
        return np.sqrt(np.maximum(gaps, 0))
    if metric == "cosine":
        queries, vectors = _unit(queries), _unit(vectors)
    return queries @ vectors.T


#: Scores held at once: more queries than that allows are scored in turn.
SCORES = 1 << 23


class _Best:
    """The k best rows per query seen so far in one task."""

    def __init__(self, names: Sequence, vectors: Sequence, k: int, least: float, metric: str):
        self.names, self.k, self.least, self.metric = list(names), k, least, metric
        self.by_size: dict[int, tuple[list[int], np.ndarray]] = {}
        sizes: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            sizes.setdefault(len(v), []).append(i)
        for size, rows in sizes.items():
            self.by_size[size] = rows, np.array([vectors[i] for i in rows], dtype=np.float64).reshape(len(rows), size)
        self.kept = pd.DataFrame({"q": [], "id": [], "score": []})

    def add(self, ids: np.ndarray, vectors: Sequence) -> None:
        sizes = np.array([len(v) for v in vectors])
        found = [self.kept] if len(self.kept) else []
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            block = np.array([vectors[i] for i in at], dtype=np.float64).reshape(len(at), size)
            step = max(1, SCORES // len(at))
            for dim, (rows, queries) in self.by_size.items():
                for i in range(0, len(rows), step):
                    tile = np.array(rows[i : i + step])
                    if dim == size:
                        scores = np.round(_scores(queries[i : i + step], block, self.metric), DIGITS[self.metric])
                    elif self.metric == "cosine":
                        scores = np.zeros((len(tile), len(at)))  # another dimension has no similarity
                    else:
                        continue
                    found.append(self._best(self._top(tile, ids[at], scores)))
        if found:
            self.kept = self._best(pd.concat(found, ignore_index=True))

    def _top(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pd.DataFrame:
        # everything that ties with the k-th score stays, ids decide later
        ranked = scores if self.metric == "euclid" else -scores
        if ranked.shape[1] > self.k > 0:
            limit = np.partition(ranked, self.k - 1, axis=1)[:, self.k - 1 : self.k]
        else:
            limit = np.full((len(rows), 1), np.inf)
        keep = (ranked <= limit) & (scores >= self.least)
        q, v = np.nonzero(keep)
        return pd.DataFrame({"q": rows[q], "id": ids[v], "score": scores[q, v]})

    def _best(self, frame: pd.DataFrame) -> pd.DataFrame:
        nearest_first = self.metric == "euclid"
        frame = frame.sort_values(["q", "score", "id"], ascending=[True, nearest_first, True])
        return frame.groupby("q", sort=False).head(self.k)

    def rows(self) -> pd.DataFrame:
        best = self.kept
        return pd.DataFrame({
            "query_id": pd.Series([self.names[int(q)] for q in best["q"]], dtype=object),
            "id": pd.Series(best["id"].to_list(), dtype=object),
            "score": best["score"].astype("float64").values,
        })


def topk(vectors: DataFrame, queries: DataFrame, k: int = 5, min_similarity: float = 0.0, metric: str = "cosine",
         id_col: str = "id", vector_col: str = "embedding", query_id: str = "query_id", query_col: str = "query",
         query_numbers: int = QUERY_NUMBERS) -> DataFrame:
    """The k best entries per query: (query_id, id, score, rank), ties by id.

    Entries of another dimension score 0 under `cosine`. Each task keeps only
    its k best rows per query, so at most k rows per query and task are
    exchanged. Blocks of queries meet slices of entries, both of bounded size.
    """
    if metric not in ("cosine", "dot", "euclid"):
        raise ValueError(f"unknown metric {metric!r}")
    if metric == "euclid":
        min_similarity = float("-inf")
    schema = f"query_id {queries.schema[query_id].dataType.simpleString()}, id {vectors.schema[id_col].dataType.simpleString()}, score double"
    entries_ = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(F.col("v").isNotNull())
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_col).alias("q")).where(F.col("q").isNotNull())
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("q")), F.lit(0)).alias("numbers")).first()

    if k <= 0:
        return entries_.sparkSession.createDataFrame([], schema + ", rank int")
    found = _blocked(entries_, asked, size, k, min_similarity, metric, schema, query_numbers)
    order = F.asc("score") if metric == "euclid" else F.desc("score")
    return top_per_group(found, ["query_id"], [order, F.asc("id")], k)


def _blocked(entries_: DataFrame, asked: DataFrame, size, k: int, least: float, metric: str, schema: str, query_numbers: int) -> DataFrame:
    """Best rows of each slice of entries for each block of queries."""
    blocks = max(1, -(-size.numbers // query_numbers))
    slices = max(1, -(-entries_.count() // ROWS_PER_SLICE))
    left = entries_.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn(
        "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))

    def meet(entry: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        best = _Best(query["query_id"].to_list(), [np.asarray(q, dtype=np.float64) for q in query["q"]], k, least, metric)
        if len(entry):
            best.add(entry["id"].to_numpy(), entry["v"].to_list())
        return best.rows()

    return left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice")).applyInPandas(meet, schema)


def responses(hits: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """One row per query with its ranked results; at most k per query, so the array is bounded."""
    if vectors is not None:
        hits = hits.join(vectors.select("id", "content", "metadata"), "id", "left")
    item = F.struct("rank", *[c for c in ("id", "score", "content", "metadata") if c in hits.columns])
    safe = item if vectors is None else F.struct("rank", "id", "score", "content", F.to_json("metadata").alias("metadata"))
    return hits.groupBy("query_id").agg(F.array_sort(F.collect_list(safe)).alias("results"))
