"""A corpus pipeline: quality, line dedup, near-duplicates, mixing, tokens.

`STAGES` lists (name, function); each function takes the session, the
documents so far and the folder of the given tables. All stages but the last
return the columns of the documents. Empty tables pass through empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm import bpe, line_dedup, mixing, quality, simhash
from rivulet.llm.common import fresh, read, stored
from rivulet.llm.queries import tokenizer_text

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SHINGLE, DISTANCE = 3, 2
MIX_SEED = 17


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    return quality.keep_good(docs)


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that recur from other documents; those that lose all their lines go. `n_chars` follows the text."""
    dropped, = fresh(docs, "dropped_lines")
    shorter = line_dedup.dedup_lines(docs, dropped=dropped)
    left = shorter.where((F.col(dropped) == 0) | F.col("text").rlike(r"\S"))
    return left.select(*[
        F.when(F.col(dropped) > 0, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c
        for c in docs.columns
    ])


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints differ by few bits: the one with the smallest id."""
    return simhash.keep_one(docs, shingle=SHINGLE, distance=DISTANCE)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources weigh the same, in random order."""
    return mixing.mix(docs, seed=MIX_SEED).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with token ids in place of their texts."""
    ids, n_tokens = fresh(docs, "ids", "n_tokens")
    coded = bpe.encode(docs, tokenizer_text(), ids=ids)
    return coded.withColumn(n_tokens, F.size(ids).cast("long")).drop("text")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("line dedup", new_lines),
    ("simhash near-dedup", distinct_documents),
    ("mixing", mixed_sources),
    ("bpe encoding", token_ids),
]

#: SQL can express neither the trained scorer nor the fingerprints; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
