"""Grouping an ordered record stream into batches and encoding each batch.

A batch closes after a number of records, before a byte cap would be passed,
when the key changes, or when it grows too old. Count and key change have a
closed form over row numbers. The byte and age rules make each batch depend on
where the one before it ended; `_greedy_starts` resolves that chain with a
partition's records spread over tasks.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rivulet.operators.ordered import RANGE, scan
from rivulet.records import as_text, parsed, payload_size


def assign_batches(df: DataFrame, max_messages: int | None = 100, max_bytes: int | None = None,
                   max_age: str | None = None, flush_on_key_change: bool = False,
                   partition_by: Sequence[str] = ("topic", "partition"), order_by: str = "offset",
                   time_col: str = "timestamp", ranges: int | None = None) -> DataFrame:
    """Add `batch_start`, the row number in its partition of the batch's first record.

    Age is measured on the partition's event-time clock, the highest time seen
    so far. A key change counts only between two non-null keys. Without a rule
    that closes them, batches have no end. `ranges` are those of `ordered.scan`.
    """
    by = list(partition_by)
    greedy = max_bytes is not None or max_age is not None
    running = {"__n": F.lit(1).cast("long")}
    if max_bytes is not None:
        running["__bytes"] = payload_size().cast("long")
    runs = {"__run": F.col("key")} if flush_on_key_change else {}
    highest = {"__clock": F.unix_micros(F.col(time_col).cast("timestamp"))} if max_age is not None else {}
    rows = scan(df, by, [order_by], running=running, runs=runs, highest=highest, ranges=ranges, keep_ranges=greedy)
    number, run = F.col("__n"), F.col("__run") if flush_on_key_change else F.lit(1)
    if greedy:
        age = int(pd.Timedelta(max_age).total_seconds() * 1_000_000) if max_age is not None else None
        cut = (run == number) if flush_on_key_change else F.lit(False)
        size = payload_size().cast("long") if max_bytes is not None else F.lit(0).cast("long")
        out = _greedy_starts(rows.withColumns({"__cut": cut, "__size": size}), _Rules(max_messages, max_bytes, age))
    else:
        out = rows.withColumn("batch_start", run if max_messages is None else number - (number - run) % max_messages)
    return out.drop("__n", "__bytes", "__clock", "__cut", "__run", "__size", RANGE)


@dataclass(frozen=True)
class _Rules:
    """When a batch begun at a record takes no more. Every batch takes its first record."""

    messages: int | None
    bytes: int | None
    age: int | None


class _Part:
    """Some neighbouring records of one range, and where batches begun there end."""

    def __init__(self, batch: pa.RecordBatch, rules: _Rules):
        numbers = lambda name: batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
        self.rules, self.size, self.n, self.own = rules, batch.num_rows, numbers("__n"), numbers("__size")
        self.upto = numbers("__bytes") if rules.bytes is not None else np.zeros(self.size, np.int64)
        # records without a time do not move the clock; before the first one it stands at the beginning
        clock = pc.fill_null(batch.column("__clock"), np.iinfo(np.int64).min // 2) if rules.age is not None else None
        self.clock = clock.to_numpy(zero_copy_only=False).astype(np.int64) if clock is not None else self.upto
        cut = batch.column("__cut").to_numpy(zero_copy_only=False).astype(bool) | (self.n == 1)
        self.cuts = np.flatnonzero(cut)
        self.ends = self._ends()

    def _ends(self) -> np.ndarray:
        """For each record, the first one here that cannot join a batch begun at it; the size if there is none."""
        at, rules = np.arange(self.size), self.rules
        ends = np.append(self.cuts, self.size)[np.searchsorted(self.cuts, at, side="right")]
        if rules.messages is not None:
            ends = np.minimum(ends, at + rules.messages)
        if rules.bytes is not None:
            total = np.cumsum(self.own)
            ends = np.minimum(ends, np.searchsorted(total, total - self.own + rules.bytes, side="right"))
        if rules.age is not None:
            for begin, end in zip(edges := np.append(np.flatnonzero((self.n == 1) | (at == 0)), self.size), edges[1:]):
                part = self.clock[begin:end]
                ends[begin:end] = np.minimum(ends[begin:end], begin + np.searchsorted(part, part + rules.age, side="left"))
        return np.maximum(ends, at + 1)

    def leave(self, states: np.ndarray) -> np.ndarray:
        """For batches begun before, the first record here that cannot join them."""
        rules, first = self.rules, int(self.cuts[0]) if len(self.cuts) else self.size
        ends = np.full(states.shape[1], first)
        if rules.messages is not None:
            ends = np.minimum(ends, states[0] + rules.messages - self.n[0])
        if rules.bytes is not None:
            ends = np.minimum(ends, np.searchsorted(self.upto[:first], states[1] + rules.bytes, side="right"))
        if rules.age is not None:
            ends = np.minimum(ends, np.searchsorted(self.clock[:first], states[2] + rules.age, side="left"))
        return np.maximum(ends, 0)

    def opened(self, at: np.ndarray) -> np.ndarray:
        """Batches begun at these records: row number, bytes before, clock."""
        return np.stack([self.n[at], self.upto[at] - self.own[at] if self.rules.bytes is not None else self.upto[at], self.clock[at]])

    def last(self) -> np.ndarray:
        """For each record, the last one here that begins a batch if it does."""
        found = np.where(self.ends < self.size, self.ends, np.arange(self.size))
        while (further := found[found]).tolist() != found.tolist():
            found = further
        return found

    def moved(self, states: np.ndarray) -> np.ndarray:
        """The batches open after these records, for those open before."""
        left = self.leave(states)
        gone = left < self.size
        states = states.copy()
        if gone.any():
            states[:, gone] = self.opened(self.last()[left[gone]])
        return states


_STATES = "starts array<long>, sizes array<long>, clocks array<long>"


def _listed(states: np.ndarray) -> list:
    return [[part.tolist()] for part in states]


def _read(row: dict, prefix: str = "") -> np.ndarray:
    """The states that a row lists."""
    return np.array([row[f"{prefix}{name}"] or [] for name in ("starts", "sizes", "clocks")], np.int64).reshape(3, -1)


def _greedy_starts(rows: DataFrame, rules: _Rules) -> DataFrame:
    """Batch starts under rules that depend on where the batch before ended.

    `rows` are in ranges. A range that continues a partition does not know
    which batch is open as it begins, so each range first tells which ones may
    be open at its end: every record up to the end of a batch begun at its first
    record may begin one, and the batches that follow soon are the same. Next,
    each range tells what the batches that may be open before it become. These
    few rows are folded in order, which fixes every range's open batch, and
    then all ranges place their batches at once.
    """
    spark = rows.sparkSession
    needed = [RANGE, "__n", "__cut", "__size", *(c for c in ("__bytes", "__clock") if c in rows.columns)]
    narrow = rows.select(*needed)
    exits_schema = f"{RANGE} int, goes_on boolean, through boolean, {_STATES}"
    moves_schema = f"{RANGE} int, goes_on boolean, entries array<long>, {_STATES}"
    entry_schema = f"{RANGE} int, {_STATES}"
    arrow = {text: to_arrow_schema(spark.createDataFrame([], text).schema) for text in (exits_schema, moves_schema, entry_schema)}
    none = np.empty((3, 0), np.int64)

    def row(schema: str, *values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, arrow[schema])], schema=arrow[schema])

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, goes_on, states, unknown = None, False, none, None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = _Part(batch, rules)
            if number is None:
                number, goes_on = batch.column(RANGE)[0].as_py(), bool(part.n[0] > 1)
                states = states if goes_on else part.opened(np.array([0]))
                unknown = part.opened(np.array([0])) if goes_on else None
            states = part.moved(states)
            if unknown is not None:
                # nothing that was open before the range takes more than a batch begun with it
                until = int(part.leave(unknown)[0])
                may = part.last()[: min(until + 1, part.size)]
                states = np.concatenate([states, part.opened(np.unique(may))], axis=1)
                unknown = unknown if until >= part.size else None
            states = states[:, np.unique(states[0], return_index=True)[1]]
        if number is not None:
            yield row(exits_schema, [number], [goes_on], [unknown is not None], *_listed(states))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = none
        for found in sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: r[RANGE]):
            before = may if found["goes_on"] else none
            if found["goes_on"]:
                yield row(entry_schema, [found[RANGE]], *_listed(before))
            may = _read(found)
            if found["through"]:
                may = np.concatenate([may, before], axis=1)
                may = may[:, np.unique(may[0], return_index=True)[1]]

    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = _Part(batch, rules)
            if number is None:
                number, goes_on = batch.column(RANGE)[0].as_py(), bool(part.n[0] > 1)
                states = _read(batch.slice(0, 1).to_pylist()[0]) if goes_on else part.opened(np.array([0]))
                begun = states[0].tolist()
            states = part.moved(states)
        if number is not None:
            yield row(moves_schema, [number], [goes_on], [begun], *_listed(states))

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = none
        for found in sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: r[RANGE]):
            after, at = _read(found), 0
            if found["goes_on"]:
                yield row(entry_schema, [found[RANGE]], *_listed(state))
                at = found["entries"].index(int(state[0, 0]))
            state = after[:, at : at + 1]

    def headed(frame: DataFrame, entry: DataFrame) -> DataFrame:
        """The frame with the range's entry beside its first row."""
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        marked = frame.withColumn("__head", F.when(place == 0, F.col(RANGE)))
        return marked.join(F.broadcast(entry.withColumnRenamed(RANGE, "__head")), "__head", "left").drop("__head")

    names = [f.name for f in rows.schema]
    placed_schema = T.StructType([*rows.schema, T.StructField("batch_start", T.LongType())])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = _Part(batch, rules)
            if state is None:
                state = _read(batch.slice(0, 1).to_pylist()[0])
            at = int(part.leave(state)[0]) if state.shape[1] else 0
            starts, ends = [], part.ends.tolist()
            while at < part.size:
                starts.append(at)
                at = ends[at]
            begun = np.searchsorted(starts, np.arange(part.size), side="right") - 1
            inherited = int(state[0, 0]) if state.shape[1] else 0
            value = np.where(begun >= 0, part.n[np.array(starts, np.int64)][np.maximum(begun, 0)], inherited) if starts else np.full(part.size, inherited)
            if starts:
                state = part.opened(np.array(starts[-1:]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(value)], names=placed_schema.names)

    may_enter = narrow.mapInArrow(exits, exits_schema).repartition(1).mapInArrow(entries, entry_schema)
    enters = headed(narrow, may_enter).mapInArrow(moves, moves_schema).repartition(1).mapInArrow(settled, entry_schema)
    return headed(rows, enters).mapInArrow(placed, placed_schema)


def _quoted(text: Column) -> Column:
    """Text as a JSON string literal."""
    listed = F.to_json(F.array(text))
    return F.when(text.isNull(), F.lit("null")).otherwise(F.regexp_replace(listed, r"(?s)^\[|\]$", ""))


def _json_value() -> Column:
    """A payload as JSON text; bytes that are not JSON become a base64 string."""
    encoded = F.concat(F.lit('"'), F.base64(F.col("value").cast("binary")), F.lit('"'))
    return F.when(F.col("value").isNotNull(), F.when(parsed().isNotNull(), as_text("value")).otherwise(encoded))


def _with_metadata() -> Column:
    key = F.when(F.col("key").isNotNull(), F.concat(F.lit('"'), F.base64(F.col("key").cast("binary")), F.lit('"')))
    stamp = F.date_format(F.col("timestamp").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0'xxx")
    return F.concat(
        F.lit('{"topic":'), _quoted(F.col("topic")),
        F.lit(',"partition":'), F.col("partition"),
        F.lit(',"offset":'), F.col("offset"),
        F.lit(',"key":'), F.coalesce(key, F.lit("null")),
        F.lit(',"value":'), F.coalesce(_json_value(), F.lit("null")),
        F.lit(',"timestamp":"'), stamp, F.lit('"}'),
    )


@F.pandas_udf(T.BinaryType())
def gzipped(payload: pd.Series) -> pd.Series:
    return payload.map(lambda data: None if data is None else gzip.compress(bytes(data), mtime=0))


def record_text(format: str = "json-array", include_metadata: bool = False) -> Column:
    """What one record adds to its batch."""
    if format == "raw":
        return as_text("value")
    return _with_metadata() if include_metadata else _json_value()


def joined_texts(texts: Column, format: str, separator: str) -> Column:
    """A batch's payload from its records' texts in order."""
    filled = F.transform(texts, lambda t: F.coalesce(t, F.lit("")))
    if format == "json-lines":
        # lines of null values are empty, but none is written before the first text
        begun = F.array_position(F.transform(filled, lambda t: t != ""), True)
        return F.when(begun > 0, F.array_join(F.slice(filled, begun.cast("int"), F.size(filled)), separator)).otherwise("")
    if format == "raw":
        return F.array_join(filled, separator)
    return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))


def pack(batched: DataFrame, format: str = "json-array", key_strategy: str = "first", separator: str = "\n",
         include_metadata: bool = False, compression: str = "none",
         partition_by: Sequence[str] = ("topic", "partition"), order_by: str = "offset") -> DataFrame:
    """One row per batch: key, value, message_count, total_bytes, compressed.

    A batch is bounded by its caps, so gathering its records is bounded too.
    """
    # keys and texts apart, so that a query of either does not make the other
    key_text, at = as_text("key"), F.col(order_by)
    known = F.when(key_text.isNotNull(), at)
    if key_strategy == "concat":
        key = F.array_sort(F.collect_list(F.when(key_text.isNotNull(), F.struct(at.alias("at"), key_text.alias("key")))))
    elif key_strategy == "null":
        key = F.first(F.lit(None).cast("string"))
    else:
        key = F.max_by(key_text, known) if key_strategy == "last" else F.min_by(key_text, known)
    item = F.struct(at.alias("at"), record_text(format, include_metadata).alias("text"))
    groups = batched.groupBy(*partition_by, "batch_start").agg(
        key.alias("__keys"),
        F.array_sort(F.collect_list(item)).alias("items"),
        F.count(F.lit(1)).alias("message_count"),
        F.sum(payload_size()).alias("total_bytes"),
    )
    key = F.col("__keys")
    if key_strategy == "concat":
        key = F.when(F.size(key) > 0, F.array_join(F.transform(key, lambda k: k["key"]), separator))
    value = joined_texts(F.transform("items", lambda i: i["text"]), format, separator).cast("binary")
    zipped = compression == "gzip"
    return groups.select(
        *partition_by, "batch_start",
        key.cast("binary").alias("key"),
        (gzipped(value) if zipped else value).alias("value"),
        "message_count", "total_bytes", F.lit(zipped).alias("compressed"),
    )


def batch(df: DataFrame, format: str = "json-array", key_strategy: str = "first", separator: str = "\n",
          include_metadata: bool = False, compression: str = "none",
          partition_by: Sequence[str] = ("topic", "partition"), order_by: str = "offset", **rules) -> DataFrame:
    """Assign records to batches and encode every batch as one record."""
    batched = assign_batches(df, partition_by=partition_by, order_by=order_by, **rules)
    return pack(batched, format, key_strategy, separator, include_metadata, compression, partition_by, order_by)
