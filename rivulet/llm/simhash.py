"""SimHash near-duplicates: fingerprints linked through a pigeonring filter.

Differences between two fingerprints are counted per segment of a ring. If
all segments together differ in at most t bits, some start on the ring has
every chain of l segments from it within l * t / segments bits. The longest
chains whose budget is below one bit must be equal, so they are an equality
join; longer chains prune what the join brings before the full comparison.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rivulet.llm.common import adding, fresh, stored
from rivulet.llm.components import components

BITS = 64
SEED = 42
SEGMENTS = 5
#: Candidate buckets up to this many fingerprints are joined in pairs; the others go through common neighbours.
BUCKET = 32


def _fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64-bit fingerprint: the bits set in over half of the shingles' hashes."""
    # bytes.lower() and bytes.split() know A-Z and the six ASCII white-space characters only
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype=np.uint64)
    counts = np.zeros(BITS, dtype=np.int64)
    for begin in range(0, len(hashes), 4096):
        block = hashes[begin : begin + 4096].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", column: str = "fingerprint", shingle: int = 3) -> DataFrame:
    """Add the 64-bit fingerprint of the whole text; null and empty texts get 0."""

    def fingerprints(texts: list) -> list[pa.Array]:
        return [pa.array([_fingerprint(x, shingle) for x in texts], pa.int64())]

    return adding(docs, text, [T.StructField(column, T.LongType())], fingerprints)


def _segments(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment of the ring."""
    cuts = [round(i * BITS / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _bits_of(value: Column, ring: list[tuple[int, int]], start: int, length: int) -> Column:
    """The bits of `length` segments from `start` on, the others zero."""
    mask = 0
    for i in range(length):
        first, width = ring[(start + i) % len(ring)]
        mask |= ((1 << width) - 1) << first
    return value.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask).cast("long"))


def _chain(segments: int, distance: int) -> int:
    """Segments in the longest chain that must be equal: its budget is below one bit."""
    return max(n for n in range(1, segments + 1) if n * distance < segments) if distance else segments


def link_fingerprints(prints: DataFrame, distance: int = 2, segments: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """Edges (`a`, `b`) that connect all distinct fingerprints (column `fp`) at `distance` bits or fewer.

    Every edge is such a link, and every link's ends are connected by edges.
    Buckets of the equality join hold up to `bucket` fingerprints each and give
    pairs. A fingerprint from a larger bucket (a group of near copies) is
    instead sent to all values within half the distance: two linked
    fingerprints meet at such a value, and all that meet there are linked with
    its smallest one, so no group is paired up.
    """
    if distance >= segments:
        raise ValueError("the ring needs more segments than differing bits")
    if distance % 2:
        raise ValueError("common neighbours need an even distance")
    ring, chain = _segments(segments), _chain(segments, distance)
    keyed = prints.select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("start"), _bits_of(F.col("fp"), ring, i, chain).alias("key")) for i in range(segments)
        ])).alias("at"),
    ).select("fp", "at.start", "at.key")
    sizes = stored(keyed.groupBy("start", "key").agg(F.count("*").alias("n")).where("n > 1"))
    shared = stored(keyed.join(sizes, ["start", "key"]))

    few = shared.where(F.col("n") <= bucket).select("start", "key", "fp")
    left, right = few.withColumnRenamed("fp", "a"), few.withColumnRenamed("fp", "b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    within = F.lit(False)
    for start in range(segments):  # the budgets of the longer chains from the bucket's own start
        chains = F.col("start") == start
        for length in range(chain + 1, segments):
            chains &= F.bit_count(_bits_of(differ, ring, start, length)) * segments <= length * distance
        within |= chains
    pairs = left.join(right, ["start", "key"]).where(F.col("a") < F.col("b")).where(within)
    pairs = pairs.where(F.bit_count(differ) <= distance).select("a", "b").distinct()

    crowded = shared.where(F.col("n") > bucket).select("fp").distinct()
    return pairs.union(_neighbour_links(crowded, distance))


def _neighbour_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links through values within half the distance of both ends, as stars.

    At most C(64, distance / 2) + ... + 1 fingerprints can meet at a value, so
    groups stay small whatever the data.
    """
    flips = [0]
    for _ in range(distance // 2):
        flips = sorted({f ^ (1 << bit) for f in flips for bit in range(BITS)} | set(flips))
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in flips]
    meet = prints.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(f).cast("long")) for f in signed])).alias("value"))
    stars = meet.groupBy("value").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all")).where(F.size("all") > 1)
    return stars.select("a", F.explode("all").alias("b")).where("a <> b").distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2, segments: int = SEGMENTS
) -> DataFrame:
    """One row per document: `key`, `fingerprint` (16 hex digits), `component_id`.

    `component_id` is the smallest key that is reached over fingerprints at
    most `distance` bits apart, the document itself included. Null and empty
    texts have fingerprint zero and link like any other. Documents with a null
    key are linked too, but name no component unless all keys in it are null.
    Repeated rows stay repeated; other columns are not read. An empty table
    gives an empty result.
    """
    hashed = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    prints = stored(with_fingerprint(hashed, "text", "fp", shingle).drop("text"))
    classes = stored(prints.groupBy("fp").agg(F.min("id").alias("least")))
    found = components(link_fingerprints(classes.select("fp"), distance, segments))
    linked = classes.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(linked.select("fp", "component").join(least, "component").select(F.col("fp").alias("f"), "component_id"))
    return prints.join(named, F.col("fp") == F.col("f")).select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """The documents whose key is the smallest of their component, with their own columns.

    Where a key is repeated or null, the rows with the same key are judged
    alike: all rows of the component's smallest key stay if their texts are in it.
    """
    found = near_duplicates(docs, key, text, shingle, distance)
    mine, = fresh(docs, "kept_key")
    kept = found.where(F.col(key).eqNullSafe(F.col("component_id"))).select(F.col(key).alias(mine)).distinct()
    return docs.join(kept, docs[key].eqNullSafe(kept[mine]), "left_semi")
