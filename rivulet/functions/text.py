"""Text helpers shared by chunking and language jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

# Unicode white space (fixed values): controls, spaces, line and paragraph separators.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(text: Column) -> Column:
    """Text without Unicode white space at its ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def words(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def counted(tokens: Column, vocabulary: list[str]) -> Column:
    """How many tokens belong to a vocabulary."""
    return F.size(F.filter(tokens, lambda t: t.isin(*vocabulary)))


#: Rows that are Python objects at a time, and characters of an Arrow array of them before the next one begins.
HELD, WEIGHT = 1 << 14, 4 << 20


def rows_of(df: DataFrame, kept: Sequence[str], value: Column, find: Callable[[Any], Iterable[tuple]], fields: T.StructType,
            into: str) -> DataFrame:
    """The columns `kept` and an array of structs, one per tuple that `find` yields of the row's value.

    Columns are built flat, which is far cheaper than a Python object per
    struct. Tuples are turned into them a few thousand at a time, also within
    a row, and a batch is cut into as many as its finds take, so memory does
    not grow with the rows that a batch holds.
    """
    kinds = [to_arrow_type(f.dataType) for f in fields]
    texts = [i for i, f in enumerate(fields) if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    staged = df.select(*kept, value.alias("__value"))
    schema = T.StructType([*staged.schema.fields[:-1], T.StructField(into, T.ArrayType(fields))])

    def arrays(flat: list[tuple]) -> list[pa.Array]:
        return [pa.array(column, kind) for column, kind in zip(zip(*flat), kinds)]

    def nested(done: list[list[pa.Array]], ends: list[int]) -> pa.Array:
        columns = [pa.concat_arrays(some) for some in zip(*done)] if done else [pa.array([], kind) for kind in kinds]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, names=fields.names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, ends, done, flat, weight = 0, [0], [], [], 0

            def made(end: int) -> pa.RecordBatch:
                rest = [arrays(flat)] if flat else []
                own = [column.slice(begin, end - begin) for column in batch.columns[:-1]]
                return pa.RecordBatch.from_arrays([*own, nested(done + rest, ends)], names=schema.names)

            for row, scalar in enumerate(batch.column(batch.num_columns - 1), 1):
                total = ends[-1]
                if given := scalar.as_py():
                    found = iter(find(given))
                    while some := list(islice(found, HELD)):
                        flat += some
                        total += len(some)
                        weight += 16 * len(some) + sum(len(t[i] or ()) for t in some for i in texts)
                        if len(flat) >= HELD:
                            done.append(arrays(flat))
                            flat.clear()
                ends.append(total)
                if weight >= WEIGHT:
                    yield made(row)
                    begin, ends, done, weight = row, [0], [], 0
                    flat.clear()
            if begin < batch.num_rows:
                yield made(batch.num_rows)

    return staged.mapInArrow(run, schema)
