"""State per key: latest value, observed changes, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rivulet.operators.ordered import latest_per_key, scan


def latest(df: DataFrame, key: str = "key", order: Sequence[str] = ("offset",), value: str = "value",
           history: bool = False, keep_deleted: bool = False) -> DataFrame:
    """A changelog as key-value entries with revision and operation.

    An entry without a value is a delete. By default each key keeps its last
    entry and deleted keys are left out; `history` keeps every entry.
    """
    empty = F.col(value).isNull() | (F.octet_length(F.col(value)) == 0)
    staged = df.withColumn("operation", F.when(empty, "Delete").otherwise("Put"))
    staged = staged.withColumn("revision", F.col(order[0]))
    rows = staged if history else latest_per_key(staged, [key], [F.desc(c) for c in order])
    return rows if history or keep_deleted else rows.where(F.col("operation") == "Put")


def on_change(df: DataFrame, key: Sequence[str], order: str, cols: Sequence[str], emit_first: bool = True,
              ranges: int | None = None) -> DataFrame:
    """Observations whose watched columns differ from the key's previous observation."""
    watched = F.struct(*cols)
    seen = scan(df, list(key), [order], previous={"__before": watched}, ranges=ranges)
    first = F.col("__before").isNull()
    changed = ~first & ~F.col("__before").eqNullSafe(watched)
    return seen.where(changed | first if emit_first else changed).drop("__before")


def dedupe(df: DataFrame, ids: Sequence[str], order: Sequence[str] = (), already: DataFrame | None = None,
           watermark: tuple[str, str] | None = None) -> DataFrame:
    """One record per id: the first in `order`. Ids in `already` were emitted before.

    On a stream, give (time column, delay): an id is remembered that long.
    """
    if already is not None:
        df = df.join(already.select(*ids), list(ids), "left_anti")
    if df.isStreaming:
        if watermark:
            return df.withWatermark(*watermark).dropDuplicatesWithinWatermark(list(ids))
        return df.dropDuplicates(list(ids))
    if order:
        return latest_per_key(df, ids, [F.asc(c) for c in order])
    return df.dropDuplicates(list(ids))
