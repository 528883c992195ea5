"""Continuous forms: state changes, timed batches, write modes and replays to completion."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rivulet.operators.batching import joined_texts, record_text
from rivulet.records import as_text, payload_size
from rivulet.session import STATE_STORE
from rivulet.sinks.tables import BucketedTable, VersionedTable


def run_available(df: DataFrame, sink: Callable[[DataFrame, int], None] | str, checkpoint: str, mode: str = "append",
                  state_partitions: int | None = None) -> None:
    """Process everything available, then stop; a later call goes on from the checkpoint.

    The first run fixes how many partitions the query's state has, by default
    one per core of the cluster. State lies in RocksDB, on disk.
    """
    spark = df.sparkSession
    settings = {"spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism), **STATE_STORE}
    usual = {name: spark.conf.get(name, None) for name in settings}
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if isinstance(sink, str):
        writer = writer.outputMode("append").format("parquet").option("path", sink)
    else:
        writer = writer.outputMode(mode).foreachBatch(sink)
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        query = writer.start()  # takes a copy of the settings
    finally:
        for name, value in usual.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    query.awaitTermination()


def apply_stream(df: DataFrame, table: str, mode: str, pk: Sequence[str], order: Sequence[str], schema: T.StructType,
                 checkpoint: str, buckets: int | None = None) -> None:
    """Keep a versioned table up to date from a stream; replayed batches are recognised.

    With `buckets`, a micro-batch rewrites only the key buckets it touches.

    The query's id, which its checkpoint keeps, tells its batches from those of other queries.
    """
    spark = df.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        target = VersionedTable(spark, table) if buckets is None else BucketedTable(spark, table, pk, schema, buckets)
        target.apply(batch, mode, pk, order, schema, batch_id, writer)

    run_available(df, write, checkpoint)


#: Records of one key that are put in order in memory; more are sorted in runs that the state store holds.
SORTED, PIECE = 20_000, 200


class _InOrder(StatefulProcessor):
    """Hands each key's records of a micro-batch on by their order column, in bounded memory.

    A backlog beyond `SORTED` records goes to the state store in sorted runs,
    in pieces of `PIECE` records, and the runs are merged from there.
    """

    def __init__(self, order: str, schema: T.StructType):
        self.order, self.schema, self.most, self.piece = order, schema, SORTED, PIECE

    def init(self, handle: StatefulProcessorHandle) -> None:
        place = T.StructType([T.StructField("run", T.IntegerType()), T.StructField("piece", T.IntegerType())])
        self.spilled = handle.getMapState("spilled", place, T.StructType([T.StructField("rows", T.ArrayType(self.schema))]))

    def ordered(self, rows: Iterator[Row]) -> Iterator[Row]:
        at = lambda row: row[self.order]
        run, pieces = sorted(islice(rows, self.most), key=at), []
        while True:
            following = sorted(islice(rows, self.most), key=at)
            if not following and not pieces:
                yield from run
                return
            pieces.append(-(-len(run) // self.piece))
            for piece in range(pieces[-1]):
                self.spilled.updateValue((len(pieces), piece), ([tuple(r) for r in run[piece * self.piece : (piece + 1) * self.piece]],))
            if not following:
                break
            run = following
        del run
        yield from heapq.merge(*[self._stored(i, count) for i, count in enumerate(pieces, 1)], key=at)

    def _stored(self, run: int, pieces: int) -> Iterator[Row]:
        for piece in range(pieces):
            rows = self.spilled.getValue((run, piece)).rows
            self.spilled.removeKey((run, piece))
            for row in rows:
                yield Row(**dict(zip(self.schema.names, row)))

    def close(self) -> None:
        pass


class _Changes(_InOrder):
    def __init__(self, order: str, schema: T.StructType, cols: list[str], emit_first: bool):
        super().__init__(order, schema)
        self.cols, self.emit_first = cols, emit_first

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", T.StructType([self.schema[c] for c in self.cols]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = tuple(self.last.get()) if self.last.exists() else None
        for row in self.ordered(rows):
            now = tuple(row[c] for c in self.cols)
            if self.emit_first if before is None else before != now:
                yield row
            before = now
        if before is not None:
            self.last.update(before)


def on_change_stream(df: DataFrame, key: Sequence[str], order: str, cols: Sequence[str], emit_first: bool = True) -> DataFrame:
    """`on_change` on a stream; the state store keeps each key's last observation.

    Records are walked one by one, so a key may hold any share of a micro-batch.
    """
    return df.groupBy(*key).transformWithState(_Changes(order, df.schema, list(cols), emit_first), df.schema, "append", "none")


class _Batches(_InOrder):
    """Holds each partition's open batch in a list state, with its count, bytes, last key and time in a value state."""

    HELD = T.StructType([T.StructField("at", T.LongType()), T.StructField("key", T.StringType()), T.StructField("text", T.StringType()),
                         T.StructField("size", T.LongType())])
    OPEN = T.StructType([T.StructField("opened", T.LongType()), T.StructField("last", T.StringType()), T.StructField("timer", T.LongType())])

    def __init__(self, schema: T.StructType, out: T.StructType, max_messages, max_bytes, max_age_ms, on_key_change: bool):
        super().__init__("at", schema)
        self.out, self.max_messages, self.max_bytes, self.max_age, self.on_key_change = out, max_messages, max_bytes, max_age_ms, on_key_change

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.held = handle.getListState("held", self.HELD)
        self.open = handle.getValueState("open", self.OPEN)

    def closed(self, key, held: list[tuple]) -> Row:
        return Row(**dict(zip(self.out.names, (
            *key, held[0][0], [text for _, _, text, _ in held], [k for _, k, _, _ in held if k is not None], len(held), sum(h[3] for h in held)))))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs() if self.max_age is not None else 0
        opened, last, timer = self.open.get() if self.open.exists() else (now, None, None)
        held = [tuple(h) for h in self.held.get()] if self.held.exists() else []
        size = sum(h[3] for h in held)
        if held and self.max_age is not None and now - opened >= self.max_age:
            yield self.closed(key, held)
            held, size = [], 0
        for row in self.ordered(rows):
            changed = self.on_key_change and None not in (last, row.key) and last != row.key
            full = self.max_bytes is not None and size + row.size > self.max_bytes
            if held and (changed or full):
                yield self.closed(key, held)
                held, size = [], 0
            opened = opened if held else now
            held.append((row.at, row.key, row.text, row.size))
            size, last = size + row.size, row.key
            if self.max_messages is not None and len(held) >= self.max_messages:
                yield self.closed(key, held)
                held, size = [], 0
        self._keep(held, opened, last, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        opened, last, _ = self.open.get()
        held = [tuple(h) for h in self.held.get()] if self.held.exists() else []
        if held:
            yield self.closed(key, held)
        self._keep([], opened, last, None)

    def _keep(self, held: list[tuple], opened: int, last, timer) -> None:
        due = opened + self.max_age if held and self.max_age is not None else None
        if timer != due:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        self.open.update((opened, last, due))
        if held:
            self.held.put(held)
        else:
            self.held.clear()


def stream_batches(df: DataFrame, format: str = "json-array", key_strategy: str = "first", separator: str = "\n",
                   include_metadata: bool = False, max_messages: int | None = 100, max_bytes: int | None = None,
                   max_age_ms: int | None = None, flush_on_key_change: bool = False,
                   partition_by: Sequence[str] = ("topic", "partition"), order_by: str = "offset") -> DataFrame:
    """The batches of a stream in any format: `first_offset`, key, value, message_count, total_bytes.

    A batch closes once it has `max_messages` records, before a record that
    would take it beyond `max_bytes`, before a record with another key (both
    known), or once its first record waited `max_age_ms`: later records do not
    move that time, and a timer closes the batch if none come. The open batch
    lies in the state store and must be bounded by one of the rules; a
    micro-batch's records are walked one by one, so one partition may hold them
    all. Needs the RocksDB state store, which `run_available` sets.
    """
    by = list(partition_by)
    rows = df.select(*by, F.col(order_by).cast("long").alias("at"), as_text("key").alias("key"),
                     record_text(format, include_metadata).alias("text"), payload_size().cast("long").alias("size"))
    out = T.StructType([*[rows.schema[c] for c in by], T.StructField("first_offset", T.LongType()), T.StructField("texts", T.ArrayType(T.StringType())),
                        T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("message_count", T.LongType()),
                        T.StructField("total_bytes", T.LongType())])
    made = rows.groupBy(*by).transformWithState(
        _Batches(rows.schema, out, max_messages, max_bytes, max_age_ms, flush_on_key_change), out, "append",
        "none" if max_age_ms is None else "processingTime")
    keys = F.col("keys")
    key = {
        "last": F.try_element_at(keys, F.lit(-1)), "null": F.lit(None).cast("string"),
        "concat": F.when(F.size(keys) > 0, F.array_join(keys, separator)),
    }.get(key_strategy, F.try_element_at(keys, F.lit(1)))
    return made.select(*by, "first_offset", key.cast("binary").alias("key"),
                       joined_texts(F.col("texts"), format, separator).cast("binary").alias("value"), "message_count", "total_bytes")


def timed_batches(df: DataFrame, max_messages: int = 100, max_age_ms: int = 1000,
                  partition_by: Sequence[str] = ("topic", "partition")) -> DataFrame:
    """JSON-array batches of a stream whose values are JSON texts, closed by count or once the oldest record waited `max_age_ms`."""
    rows = df.withColumns({"value": F.col("value").cast("string"), "key": F.lit(None).cast("binary")})
    made = stream_batches(rows, "raw", separator=",", max_messages=max_messages, max_age_ms=max_age_ms, partition_by=partition_by)
    return made.select(*partition_by, "first_offset", F.col("message_count").cast("int").alias("message_count"),
                       F.concat(F.lit("["), F.col("value").cast("string"), F.lit("]")).alias("value"))


def heartbeats(spark: SparkSession, source: str, target: str, per_second: int = 1) -> DataFrame:
    """A stream of heartbeats between two clusters."""
    beat = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return beat.select(F.lit(source).alias("source_cluster"), F.lit(target).alias("target_cluster"),
                       F.unix_millis("timestamp").alias("timestamp"))
