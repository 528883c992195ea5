"""Arrow batches as Python rows and back, with whole numbers, nulls and maps as they are."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def python_rows(batch: pa.RecordBatch) -> list[dict]:
    return batch.to_pylist(maps_as_pydicts="lossy")


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def _pairs(value, kind: pa.DataType):
    return list(value.items()) if pa.types.is_map(kind) and isinstance(value, dict) else value


def arrow_batch(rows: Iterable[dict], schema: pa.Schema) -> pa.RecordBatch:
    """Rows that lack a column have null there."""
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([_pairs(r.get(f.name), f.type) for r in rows], f.type) for f in schema], schema=schema)
