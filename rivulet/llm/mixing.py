"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm.common import fresh, stored

#: Highest mean of one Poisson draw; larger means are sums of independent draws.
STEP = 16.0
#: Sources up to this number are sent to all tasks; more are joined by source and slice.
SMALL = 10_000
SLICES = 64
#: Thirteen hexadecimal digits of a digest are the numerator of a uniform number.
DIGITS = 13


def uniform(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) from the digest of the values; nulls count as a value of their own."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") / float(16**DIGITS)


def cumulative(mean: Column) -> Column:
    """Probabilities of at most 0, 1, 2, ... for a Poisson mean up to STEP, until the rest is below a double's reach."""
    most = math.ceil(STEP + 12 * math.sqrt(STEP) + 20)
    state = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("sums"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(most)), state,
        lambda s, k: F.struct((s["p"] * mean / k).alias("p"), F.concat(s["sums"], F.array(F.element_at(s["sums"], -1) + s["p"] * mean / k)).alias("sums")),
        lambda s: s["sums"],
    )


def rates(docs: DataFrame, weights: dict[str, float] | None, total: int | None, source: str) -> DataFrame:
    """Per source: its documents `n`, mean repetition `rate`, and the sums that invert the distribution.

    Without weights all sources weigh the same. Sources that have no weight
    get none of the documents; documents with a null source form a source of
    their own, which only equal weights include.
    """
    counted = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weighted = counted.withColumn("weight", F.lit(1.0))
    elif not weights or min(weights.values()) < 0 or sum(weights.values()) <= 0:
        raise ValueError("weights must be non-negative and not all zero")
    else:
        given = F.create_map(*[F.lit(x) for name, w in weights.items() for x in (name, float(w))])
        weighted = counted.withColumn("weight", F.coalesce(given[F.col("source")], F.lit(0.0)))
    weighted = stored(weighted)
    sums = weighted.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    wanted = sums["n"] if total is None else total
    share = F.col("weight") / sums["weight"] if sums["weight"] else F.lit(0.0)
    rated = weighted.withColumn("rate", share * F.lit(float(wanted or 0)) / F.col("n"))
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP)).cast("int")
    return rated.select("source", "n", "rate", draws.alias("draws"), cumulative(F.col("rate") / draws).alias("sums"))


def mix(
    docs: DataFrame, weights: dict[str, float] | None = None, total: int | None = None, seed: int = 17,
    key: str = "doc_id", source: str = "source", copy: str = "copy", small: int = SMALL, slices: int = SLICES,
) -> DataFrame:
    """Documents repeated so that sources meet target weights on average, in a global random order.

    Each document's number of copies is the inverse of a Poisson distribution
    at a uniform number hashed from seed, key and draw; the mean is its
    source's share of `total` (default: as many documents as there are) over
    its documents. `copy` counts from 1. The same documents, seed and weights
    give the same copies, wherever and how often tasks run.

    Null keys share one hash and rows that repeat a key are copied equally
    often. Texts are not read; documents with empty texts count. An empty table
    stays empty. Rows are dealt to tasks by a hash of seed, key, whole row and
    copy and sorted by it within each.
    """
    n_, rate, draws, sums, name, slice_ = fresh(docs, "source_docs", "rate", "draws", "sums", "source_name", "slice")
    copy, = fresh(docs, copy)
    order, = fresh(docs, "order_hash")
    rated = rates(docs, weights, total, source).select(
        F.col("source").alias(name), F.col("rate").alias(rate), F.col("draws").alias(draws), F.col("sums").alias(sums)
    )
    rated = rated.where(F.col(rate) > 0)
    if rated.count() <= small:
        joined = docs.join(F.broadcast(rated), F.col(source).eqNullSafe(F.col(name)))
    else:  # a heavy source is spread over slices
        spread = rated.withColumn(slice_, F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        joined = docs.withColumn(slice_, F.pmod(F.xxhash64(*docs.columns), F.lit(slices)).cast("int")).join(
            spread.withColumnRenamed(slice_, slice_ + "_"), F.col(source).eqNullSafe(F.col(name)) & (F.col(slice_) == F.col(slice_ + "_"))
        )
    # copies of one draw: how many sums its uniform number has reached
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col(draws)), F.lit(0),
        lambda total_, i: total_ + F.aggregate(F.array(uniform(seed, F.col(key), i)), F.lit(0), lambda _, u: F.size(F.filter(F.col(sums), lambda s: s <= u))),
    )
    copies = joined.withColumn(n_, drawn).where(F.col(n_) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n_))))
    hashed = copies.withColumn(order, F.xxhash64(F.lit(seed), F.col(key), F.col(copy), *[F.col(c) for c in docs.columns]))
    return hashed.repartition(order).sortWithinPartitions(order).select(*docs.columns, copy)
