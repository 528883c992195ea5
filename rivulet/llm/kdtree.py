"""Exact top-k by inner product over KD-trees, one per shard of the vectors.

A tree splits its shard at medians and keeps a tight bounding box per node. A
box and a query bound the score of everything in the box, so the search
visits boxes best first and stops at the first whose bound is below the k-th
score so far. The k-th score found in one shard travels to all others.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm.common import parts, stored

SHARD = 8192
LEAF = 128
#: Queries that meet one shard in one task.
BLOCK = 2048
#: Sums of products below this are exact in doubles.
EXACT = 1 << 53


def whole_numbers(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component as long, null where the vector is null or holds null or non-finite ones."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


class Tree:
    """A KD-tree over whole-number vectors; nodes are rows of arrays."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.points, self.ids = points, ids
        self.low, self.high, self.children, self.rows = [], [], [], []
        self._add(np.arange(len(points)), leaf)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _add(self, rows: np.ndarray, leaf: int) -> int:
        node, own = len(self.rows), self.points[rows]
        low, high = own.min(axis=0), own.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        self.rows.append(rows)
        spread = high - low
        if len(rows) > leaf and spread.max() > 0:
            half = len(rows) // 2
            order = np.argpartition(own[:, int(spread.argmax())], half)
            self.rows[node] = None
            self.children[node] = (self._add(rows[order[:half]], leaf), self._add(rows[order[half:]], leaf))
        return node

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """The highest score that any point of each node's box can have."""
        return self.high @ np.maximum(query, 0) + self.low @ np.minimum(query, 0)

    def search(self, query: np.ndarray, own: int, k: int, floor: float) -> list[tuple[int, int]]:
        """(score, row) of the k best points other than the query's own, best first, smaller ids first in ties.

        Points below `floor`, a k-th score known from elsewhere, may be missing.
        """
        bound = self.bounds(query)
        waiting, kth = [(-bound[0], 0)], floor
        scores, best_rows = np.empty(0, self.points.dtype), np.empty(0, np.int64)
        while waiting:
            best, node = heapq.heappop(waiting)
            if -best < kth:
                break
            if self.children[node]:
                for child in self.children[node]:
                    if bound[child] >= kth:
                        heapq.heappush(waiting, (-bound[child], child))
                continue
            rows = self.rows[node]
            score = self.points[rows] @ query
            fits = (score >= kth) & (self.ids[rows] != own)
            if fits.any():
                scores, best_rows = np.concatenate([scores, score[fits]]), np.concatenate([best_rows, rows[fits]])
                order = np.lexsort((self.ids[best_rows], -scores))[:k]
                scores, best_rows = scores[order], best_rows[order]
                if len(scores) == k:
                    kth = max(kth, scores[-1])
        return [(int(s), int(i)) for s, i in zip(scores, best_rows)]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.asarray(x, dtype=np.int64) for x in column])


def _search(k: int, leaf: int):
    def run(shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [], "vec_id": [], "score": [], "copies": []}
        if len(shard) and len(queries):
            points, asked = _matrix(shard["v"]), _matrix(queries["q"])
            largest = float(np.abs(points).max(initial=0)) * float(np.abs(asked).max(initial=0)) * points.shape[1]
            if largest < EXACT:  # doubles multiply faster and are exact here
                points, asked = points.astype(np.float64), asked.astype(np.float64)
            elif largest >= 2.0**63:
                points, asked = points.astype(object), asked.astype(object)
            tree = Tree(points, shard["vec_id"].to_numpy(), leaf)
            copies = shard["copies"].to_numpy()
            floors = queries["floor"].to_numpy(dtype=object)
            for query, own, floor in zip(asked, queries["query_id"], floors):
                floor = -math.inf if floor is None or floor != floor else floor
                for score, row in tree.search(query, own, k, floor):
                    found["query_id"].append(own)
                    found["vec_id"].append(tree.ids[row])
                    found["score"].append(score)
                    found["copies"].append(copies[row])
        return pd.DataFrame(found).astype(dict.fromkeys(found, "int64"))

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "v", query_key: str = "query_id",
    shard: int = SHARD, block: int = BLOCK, leaf: int = LEAF,
) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score`: each query's k highest integer inner products.

    Vectors and queries are arrays of longs; those that are null, have a null
    key or differ in length from the other side take no part. Ties go to the
    smaller id. A vector with the query's own id is not among its results.
    Rows that repeat both id and vector are that many results; they are searched
    once. A query row that is repeated asks once. Scores beyond 64 bits fail. Queries with fewer than k other vectors get all of them. Other
    columns are not read; empty tables give no rows.

    Vectors are dealt evenly over shards by a hash, so no key makes one large.
    Blocks of queries meet every shard; the first shard is searched before the
    others and its k-th scores bound their searches.
    """
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v")).where("vec_id is not null and v is not null")
    asked = queries.select(F.col(query_key).cast("long").alias("query_id"), F.col(vector).alias("q")).where("query_id is not null and q is not null")
    rows, asked = stored(rows.groupBy("vec_id", "v").agg(F.count("*").alias("copies"))), stored(asked.distinct())
    dealt = F.xxhash64("vec_id", "v")
    sizes = rows.groupBy(F.size("v").alias("dims")).count().withColumn("shards", F.ceil(F.col("count") / shard).cast("int"))
    blocks = parts(asked.count(), block)
    own_block = F.pmod(F.xxhash64("query_id", "q"), F.lit(blocks)).cast("int")
    sizes = sizes.select("dims", "shards")
    points = rows.withColumn("dims", F.size("v")).join(sizes, "dims").select(
        "dims", "vec_id", "v", "copies", F.pmod(dealt, F.col("shards")).cast("int").alias("shard")
    )
    questions = asked.withColumn("dims", F.size("q")).join(sizes, "dims").select("dims", "shards", "query_id", "q", own_block.alias("block"))
    block_numbers = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def searched(some: DataFrame, against: DataFrame) -> DataFrame:
        by = ["dims", "shard", "block"]
        return some.withColumn("block", block_numbers).groupBy(*by).cogroup(against.groupBy(*by)).applyInPandas(
            _search(k, leaf), "query_id long, vec_id long, score long, copies long"
        )

    first = stored(searched(
        points.where("shard = 0"),
        questions.select("dims", F.lit(0).alias("shard"), "block", "query_id", "q", F.lit(None).cast("long").alias("floor")),
    ))
    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low")).select(
        "query_id", F.when(F.col("n") >= k, F.col("low")).alias("floor")
    )
    others = questions.where("shards > 1").join(kth, "query_id", "left").withColumn(
        "shard", F.explode(F.sequence(F.lit(1), F.col("shards") - 1))
    ).select("dims", "shard", "block", "query_id", "q", "floor")
    found = first.union(searched(points.where("shard > 0"), others))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # the k best without copies hold the k best with them
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k)))))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
