"""Helpers shared by the operators of this package."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rivulet.plans.inputs import scratch, table

__all__ = ["adding", "fresh", "read", "stored"]


def read(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A given table, or some of its columns."""
    rows = table(spark, folder, name)
    return rows.select(*columns) if columns else rows


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read again: one job, and no lineage behind it."""
    folder = scratch(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, with underscores added where the frame has such a column already."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def slices(batch: pa.RecordBatch, weight: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most `most` bytes in one column (one row at least)."""
    column = batch.column(weight)
    sizes = [n or 0 for n in pc.binary_length(column).to_pylist()]
    begin = total = 0
    for row, size in enumerate(sizes):
        if row > begin and total + size > most:
            yield batch.slice(begin, row - begin)
            begin, total = row, 0
        total += size
    if begin < len(sizes):
        yield batch.slice(begin)


def adding(
    df: DataFrame, source: str, fields: list[T.StructField], fn: Callable[[list], list[pa.Array]], most: int = 8 << 20
) -> DataFrame:
    """The frame with columns that `fn` makes of one text column, a few megabytes of it at a time.

    `fn` gets the column's values (None for null) and returns one Arrow array
    per field. The other columns pass through as they are; one that has the
    name of a new column gives way to it.
    """
    new = {f.name.lower() for f in fields}
    kept = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in new]
    schema = T.StructType([*[df.schema.fields[i] for i in kept], *fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, source, most):
                made = fn(part.column(source).to_pylist())
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in kept], *made], names=names)

    return df.mapInArrow(run, schema)


def parts(rows: int, most: int) -> int:
    return max(1, math.ceil(rows / most))
