"""Bookkeeping of topics replicated between clusters."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.operators.ordered import latest_per_key, scan, top_per_group

# Names that mark topics and groups of the replication itself (fixed values).
INTERNAL_SUFFIXES = (".heartbeats", ".checkpoints.internal", ".offset-syncs.internal")
INTERNAL_PREFIX = "__"
INTERNAL_GROUPS = ("connect-", "mirror-maker-")


def is_internal(topic: Column) -> Column:
    test = topic.startswith(INTERNAL_PREFIX)
    for suffix in INTERNAL_SUFFIXES:
        test |= topic.endswith(suffix)
    return test


def _decided(name: Column, allow: Sequence[str], deny: Sequence[str], pattern: str | None) -> Column:
    if allow:
        test = name.isin(*allow)
    elif pattern:
        test = name.rlike(f"(?s){pattern}")
    else:
        test = F.lit(True)
    return test & ~name.isin(*deny) if deny else test


def select_topics(df: DataFrame, allow: Sequence[str] = (), deny: Sequence[str] = (), pattern: str | None = None,
                  topic: str = "topic") -> DataFrame:
    """Topics to replicate: never internal or denied ones, then the allow list or the pattern decides."""
    name = F.col(topic)
    return df.where(~is_internal(name) & _decided(name, allow, deny, pattern))


def select_groups(df: DataFrame, allow: Sequence[str] = (), deny: Sequence[str] = (), pattern: str | None = None,
                  group: str = "group") -> DataFrame:
    """Consumer groups to follow, by the same rules, without the replicators' own groups."""
    name = F.col(group)
    own = F.lit(False)
    for prefix in INTERNAL_GROUPS:
        own |= name.startswith(prefix)
    return df.where(~own & _decided(name, allow, deny, pattern))


def topic_source(topic: Column, sep: str = ".") -> Column:
    """The text before the first separator, null for internal and unprefixed topics."""
    at = F.instr(topic, sep)
    return F.when(~is_internal(topic) & (at > 1), F.substring(topic, F.lit(1), at - 1))


def remote_topic(df: DataFrame, alias: str, target: str | None = None, sep: str = ".", identity: bool = False,
                 topic: str = "topic") -> DataFrame:
    """Add the remote name, original name, upstream path and loop flag of each topic."""
    name = F.col(topic)
    source = topic_source(name, sep)
    if identity:
        remote, original, path = name, name, F.array().cast("array<string>")
    else:
        remote = F.when(source.isNotNull(), name).otherwise(F.concat(F.lit(alias + sep), name))
        original = F.when(source.isNotNull(), F.substring(name, F.length(source) + 1 + len(sep), F.length(name))).otherwise(name)
        parts = F.split(name, re.escape(sep))
        stops = F.transform(parts, lambda p: (p == "") | p.startswith(INTERNAL_PREFIX))
        stop = F.array_position(stops, True).cast("int")
        length = F.when(stop > 0, stop - 1).otherwise(F.size(parts) - 1)
        path = F.when(is_internal(name), F.array().cast("array<string>")).otherwise(
            F.slice(parts, F.lit(1), F.least(length, F.size(parts) - 1)))
    loop = name.startswith(target + sep) if target and not identity else F.lit(False)
    return df.withColumns({"remote": remote, "original": original, "upstream": path, "loop": loop})


def replicate(df: DataFrame, alias: str, target: str | None = None, allow: Sequence[str] = (), deny: Sequence[str] = (),
              pattern: str | None = None, sep: str = ".") -> DataFrame:
    """Selected records under their remote topic; records that came from the target are dropped."""
    named = remote_topic(select_topics(df, allow, deny, pattern), alias, target, sep)
    return named.where(~F.col("loop")).withColumn("topic", F.col("remote")).select(*df.columns)


PARTITION = ("cluster", "topic", "partition")


def translate(offsets: DataFrame, mappings: DataFrame, by: Sequence[str] = PARTITION, keep: int | None = None,
              ranges: int | None = None) -> DataFrame:
    """Target offsets of source offsets (column `offset` -> `target_offset`).

    An exact mapping counts; between two mappings the offset is interpolated,
    before the first it is the first target, after the last the distance is
    kept. Without mappings the result is null. `keep` uses only the newest
    mappings of each partition.

    Offsets and mappings lie in one order, through one exchange; each range of
    it is walked up and down for the neighbours, so neither a hot partition nor
    the pairs of offset and mapping pile up.
    """
    by = list(by)
    known = mappings
    if keep is not None:
        newest = mappings.groupBy(*by, "source_offset").agg(F.max("target_offset").alias("target_offset"))
        known = top_per_group(newest, by, [F.desc("source_offset")], keep).drop("rank")
    point = F.struct(F.col("source_offset").alias("source"), F.col("target_offset").alias("target"))
    # of several mappings of one offset the highest counts: it is the nearest to the offsets asked for, going either way
    marks = known.select(*by, F.col("source_offset").alias("offset"), point.alias("__point"), F.lit(0).alias("__asked"))
    both = offsets.withColumn("__asked", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    found = scan(both, by, ["offset", "__asked", "__point"], latest={"__low": F.col("__point")}, following={"__high": F.col("__point")}, ranges=ranges)
    found = found.select("*", F.col("__low.source").alias("__low_source"), F.col("__low.target").alias("__low_target"),
                         F.col("__high.source").alias("__high_source"), F.col("__high.target").alias("__high_target"))

    at, low_source, low, high_source, high = (
        F.col(c) for c in ("offset", "__low_source", "__low_target", "__high_source", "__high_target"))
    ratio = (at - low_source).cast("double") / (high_source - low_source)
    target = (
        F.when(low_source == at, low)
        .when(low_source.isNull(), high)
        .when(high_source.isNull(), low + (at - low_source))
        .otherwise(low + (ratio * (high - low)).cast("long"))
    )
    return found.where(F.col("__asked") == 1).withColumn("target_offset", target).select(*offsets.columns, "target_offset")


def checkpoints(commits: DataFrame, mappings: DataFrame, order: str = "timestamp", deny: Sequence[str] = (),
                allow: Sequence[str] = (), pattern: str | None = None) -> DataFrame:
    """The latest commit per group, topic and partition with its target offset; without a mapping it stays as it is."""
    followed = select_groups(commits, allow, deny, pattern).where(F.col("offset") >= 0)
    last = latest_per_key(followed, ["group", *PARTITION], [F.desc(order), F.desc("offset")])
    moved = translate(last, mappings)
    return moved.withColumn("target_offset", F.coalesce("target_offset", "offset")).withColumnRenamed("offset", "source_offset")


def lag(ends: DataFrame, commits: DataFrame) -> DataFrame:
    """Records each group has yet to read: end offset minus committed offset."""
    return commits.join(ends, ["topic", "partition"]).withColumn("lag", F.col("end_offset") - F.col("offset"))


def heartbeat_gaps(df: DataFrame, ts: str = "timestamp", received: str | None = None, ranges: int | None = None) -> DataFrame:
    """Heartbeats with the gap to the one before and, if known, their latency (all in milliseconds)."""
    seen = scan(df, ["source_cluster", "target_cluster"], [ts], previous={"__before": F.col(ts)}, ranges=ranges)
    out = seen.withColumn("gap_ms", F.col(ts) - F.col("__before")).drop("__before")
    return out.withColumn("latency_ms", F.col(received) - F.col(ts)) if received else out
