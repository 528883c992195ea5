"""Batched enrichment of records by a plug-in function, for instance a model client."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from rivulet.functions.rows import arrow_batch, arrow_schema, python_rows
from rivulet.records import as_text, parsed, text_at

Enrich = Callable[[list[str]], Sequence[dict]]


def _called(fn: Enrich, texts: list[str], retries: int, backoff: float) -> Sequence[dict]:
    for attempt in range(retries + 1):
        try:
            return fn(texts)
        except Exception:
            if attempt == retries:
                raise
            time.sleep(backoff * 2**attempt)
    return []


def enrich(df: DataFrame, make: Callable[[], Enrich], text_path: str | None = None, batch_size: int = 25, retries: int = 3,
           backoff: float = 0.1, output: str = "merge", result_field: str = "enrichment", mode: str = "enrich") -> DataFrame:
    """Records whose value carries the function's result.

    `make` builds the function once per task, so a client is opened per
    partition, not per row. A batch that keeps failing is tried row by row, and
    a row that fails on its own carries an `error` instead of a result. With
    `merge` the result joins the original payload, with `separate` it stands
    alone. `_metadata` names the record and the mode.
    """
    if output not in ("merge", "separate"):
        raise ValueError(f"unknown output {output!r}")
    json_col = F.col("__json")
    text = F.coalesce(text_at(json_col, text_path), as_text("value")) if text_path else as_text("value")
    staged = df.withColumn("__json", parsed()).withColumn("__text", text).drop("__json")
    kind = df.schema["value"].dataType
    result = T.StructType([*df.schema.fields, T.StructField("error", T.StringType())])

    def value_of(record: dict, found: dict | None, error: str | None) -> str:
        payload: dict = {}
        if output == "merge":
            raw = record["value"]
            raw = raw.decode() if isinstance(raw, (bytes, bytearray)) else raw
            try:
                payload = json.loads(raw)
            except (TypeError, ValueError):
                payload = {"value": raw}
            if not isinstance(payload, dict):
                payload = {"value": payload}
        payload[result_field] = found
        if error:
            payload["error"] = error
        payload["_metadata"] = {c: record[c] for c in ("topic", "partition", "offset") if c in record} | {"mode": mode}
        return json.dumps(payload, ensure_ascii=False, separators=(",", ":"), default=int)

    kinds = arrow_schema(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            rows = []
            records = python_rows(batch)
            for i in range(0, len(records), batch_size):
                part = records[i : i + batch_size]
                try:
                    found = [(r, None) for r in _called(fn, [p["__text"] or "" for p in part], retries, backoff)]
                except Exception:
                    found = []
                    for p in part:
                        try:
                            found.append((fn([p["__text"] or ""])[0], None))
                        except Exception as problem:
                            found.append((None, f"{type(problem).__name__}: {problem}"))
                for record, (answer, error) in zip(part, found, strict=True):
                    record.pop("__text")
                    value = value_of(record, answer, error)
                    record["value"] = value.encode() if isinstance(kind, T.BinaryType) else value
                    record["error"] = error
                    rows.append(record)
            yield arrow_batch(rows, kinds)

    return staged.mapInArrow(run, result)
