"""Ordered computations whose groups may be far larger than one task can hold.

A plain window puts every row of a group into one task. Here the rows are
exchanged once, into ranges of (group, order), so a hot group spreads over as
many tasks as it has ranges. Each range is walked in order. Only the first
group of a range can have begun before it, so one row per range tells what is
inherited: the ranges' summaries are folded in order, and what comes out is
joined back to the ranges. Both steps read the same exchange. Positions may be
as far apart as they like; ranges follow the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

RANGE, FIRST, LAST = "__range", "__scan_first", "__scan_last"


@dataclass(frozen=True)
class _Plan:
    """Names of the input columns of one scan by kind."""

    by: tuple[str, ...]
    running: tuple[str, ...]
    previous: tuple[str, ...]
    latest: tuple[str, ...]
    highest: tuple[str, ...]
    runs: tuple[str, ...]
    gaps: dict[str, int | None]


def _apart(before, now, gap: int | None) -> bool:
    """Whether a run ends between two values of neighbouring rows."""
    return before is not None and now is not None and (before != now if gap is None else now - before > gap)


def _shifted(column: pa.Array, before: pa.Array | None) -> pa.Array:
    """The column one row later, begun with the row before it, or null."""
    head = pa.nulls(1, column.type) if before is None else before
    return pa.concat_arrays([head, column.slice(0, len(column) - 1)])


def _differs(column: pa.Array, other: pa.Array) -> np.ndarray:
    """Whether the values differ; null counts as a value."""
    unequal = pc.fill_null(pc.not_equal(column, other), False)
    return pc.or_(unequal, pc.xor(column.is_valid(), other.is_valid())).to_numpy(zero_copy_only=False)


def _sums(column: pa.Array) -> np.ndarray:
    """Running sums of a whole column; nulls add nothing."""
    if pa.types.is_integer(column.type):
        return np.cumsum(pc.fill_null(column, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    if pa.types.is_floating(column.type):
        return np.cumsum(pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False).astype(np.float64))
    return np.cumsum(np.array([0 if x is None else x for x in column.to_pylist()], object))


class _Walk:
    """Results of the rows of one range, from its first row on, batch by batch."""

    def __init__(self, plan: _Plan):
        self.plan = plan
        self.rows = 0
        self.groups = 0
        self.ends: dict[str, pa.Array] = {}  # of every column that counts: the last row's value
        self.number = 0
        self.sums = {c: 0 for c in plan.running}
        self.run = {c: 0 for c in plan.runs}

    def take(self, batch: pa.RecordBatch) -> tuple[dict[str, pa.Array], np.ndarray, np.ndarray]:
        """Results by input column, the row's number in its group, and whether that is the range's first group."""
        plan, size = self.plan, batch.num_rows
        column = {c: batch.column(c) for c in (*plan.by, *plan.running, *plan.previous, *plan.latest, *plan.highest, *plan.runs)}
        index = np.arange(size)
        starts = np.zeros(size, bool)
        for c in plan.by:
            starts |= _differs(column[c], _shifted(column[c], self.ends.get(c)))
        if not self.rows:
            starts[0] = True
        begun = np.maximum.accumulate(np.where(starts, index, -1))  # -1: in an earlier batch
        number = np.where(begun >= 0, index - begun + 1, self.number + index + 1)
        group = self.groups + np.cumsum(starts)
        found: dict[str, pa.Array] = {}
        for c in plan.running:
            total = _sums(column[c])
            base = np.where(begun > 0, total[np.maximum(begun, 1) - 1], 0)
            value = np.where(begun >= 0, total - base, total + self.sums[c])
            found[f"running {c}"] = pa.array(value) if value.dtype != object else pa.array(value.tolist())
            self.sums[c] = value[-1]
        for c in plan.previous:
            value = pa.concat_arrays([self.ends.get(f"previous {c}", pa.nulls(1, column[c].type)), column[c]])
            found[f"previous {c}"] = value.take(pa.array(index, mask=starts))
        for c in plan.latest:
            both = pa.concat_arrays([self.ends.get(f"latest {c}", pa.nulls(1, column[c].type)), column[c]])
            valid = column[c].is_valid().to_numpy(zero_copy_only=False)
            last = np.maximum.accumulate(np.where(valid, index, -1))
            known = last >= np.maximum(begun, 0)
            found[f"latest {c}"] = both.take(pa.array(np.where(known, last + 1, 0), mask=~known & (begun >= 0)))
        for c in plan.highest:
            both = pa.concat_arrays([self.ends.get(f"highest {c}", pa.nulls(1, column[c].type)), column[c]])
            rank = pc.rank(both, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
            rank = np.where(both.is_valid().to_numpy(zero_copy_only=False), rank, 0)
            apart = np.concatenate([[0], group - self.groups]) * (size + 2)
            best = np.maximum.accumulate(rank + apart) - apart
            ranks, places = np.unique(rank, return_index=True)
            found[f"highest {c}"] = both.take(pa.array(places[np.searchsorted(ranks, best[1:])], mask=best[1:] == 0))
        for c in plan.runs:
            before = _shifted(column[c], self.ends.get(f"run {c}"))
            gap = plan.gaps[c]
            changed = pc.not_equal(column[c], before) if gap is None else pc.greater(pc.subtract(column[c], before), gap)
            changed = pc.fill_null(changed, False).to_numpy(zero_copy_only=False)
            mark = np.maximum.accumulate(np.where(starts | changed, index, -1))
            value = np.where(mark >= 0, number[np.maximum(mark, 0)], self.run[c])
            found[f"run {c}"] = pa.array(value)
            self.run[c] = int(value[-1])
            self.ends[f"run {c}"] = column[c].slice(size - 1)
        for c in plan.by:
            self.ends[c] = column[c].slice(size - 1)
        for c in plan.previous:
            self.ends[f"previous {c}"] = column[c].slice(size - 1)
        for kind in ("latest", "highest"):
            for c in getattr(plan, kind):
                self.ends[f"{kind} {c}"] = found[f"{kind} {c}"].slice(size - 1)
        self.rows += size
        self.groups, self.number = int(group[-1]), int(number[-1])
        return found, number, group == 1


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (batch for batch in batches if batch.num_rows)


def _comparable(value):
    return "nan" if isinstance(value, float) and value != value else value


def scan(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    *,
    running: Mapping[str, Column] | None = None,
    previous: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
    highest: Mapping[str, Column] | None = None,
    runs: Mapping[str, Column | tuple[Column, int]] | None = None,
    ranges: int | None = None,
    keep_ranges: bool = False,
) -> DataFrame:
    """Add ordered results per group: `running` sums up to and including the row, the `previous` row's value,
    the `latest` non-null value up to the row, the `following` one from the row on, the `highest` value up to
    the row, and for `runs` the row number at which the value last changed (between two non-null values), or
    for a column and a gap, last grew by more than the gap.

    `order` must be unique in a group. Rows go to `ranges` ranges (by default as many as the session's shuffle
    partitions); memory does not depend on a range's rows, and what the ranges inherit is one row each. With
    `keep_ranges`, the result keeps `__range` and stays in order within it.
    """
    spaced = {name: run if isinstance(run, tuple) else (run, None) for name, run in (runs or {}).items()}
    plain = {name: column for name, (column, _) in spaced.items()}
    kinds = {"running": running, "previous": previous, "latest": latest, "highest": highest, "run": plain, "following": following}
    inputs = {f"__{kind}_{name}": (kind, name, column) for kind, part in kinds.items() for name, column in (part or {}).items()}
    kind_of = {c: kind for c, (kind, _, _) in inputs.items()}
    of = lambda kind: tuple(c for c, k in kind_of.items() if k == kind)
    forward = of("following")
    plan = _Plan(tuple(by), of("running"), of("previous"), of("latest"), of("highest"), of("run"),
                 {f"__run_{name}": gap for name, (_, gap) in spaced.items()})
    count = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a given number of ranges: every step below sees the same ones, through one exchange
    rows = (
        df.withColumns({c: column for c, (_, _, column) in inputs.items()})
        .repartitionByRange(count, *by, *order).sortWithinPartitions(*by, *order)
        .withColumn(RANGE, F.spark_partition_id())
    )
    types = {c: f.dataType for c, f in zip(inputs, rows.select(*inputs).schema)}
    for c in plan.running:
        types[c] = rows.agg(F.sum(c)).schema[0].dataType
    for c in plan.runs:
        types[c] = T.LongType()
    results = [c for c, (kind, _, _) in inputs.items() if kind != "following"]
    local = T.StructType([*rows.schema, T.StructField("__scan_number", T.LongType()), T.StructField(FIRST, T.BooleanType()),
                          *[T.StructField(f"{c}_local", types[c]) for c in results]])
    local_arrow = to_arrow_schema(local)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk(plan)
        for batch in _rows_of(batches):
            found, number, first = walk.take(batch)
            made = [found[f"{kind_of[c]} {c}"].cast(local_arrow.field(f"{c}_local").type) for c in results]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number), pa.array(first), *made], names=local.names)

    value = {c: f.dataType for c, f in zip(inputs, rows.select(*inputs).schema)}
    summary = T.StructType([
        T.StructField(RANGE, T.IntegerType()), T.StructField("number", T.LongType()), T.StructField("groups", T.LongType()),
        *[T.StructField(f"{side} {c}", rows.schema[c].dataType) for side in ("first", "last") for c in by],
        *[T.StructField(c, types[c]) for c in results],
        *[T.StructField(f"{side} {c}", value[c]) for side in ("first", "last") for c in plan.runs],
        *[T.StructField(c, value[c]) for c in forward],
    ])
    summary_arrow = to_arrow_schema(summary)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, head, found, ahead, batch = _Walk(plan), None, {}, {}, None
        for batch in _rows_of(batches):
            head = batch.slice(0, 1) if head is None else head
            found, _, first = walk.take(batch)
            for c in forward:
                if c not in ahead:
                    some = np.flatnonzero(batch.column(c).is_valid().to_numpy(zero_copy_only=False) & first)
                    if len(some):
                        ahead[c] = batch.column(c).slice(some[0], 1)
        if head is None:
            return
        size = batch.num_rows
        made = [head.column(RANGE), pa.array([walk.number]), pa.array([walk.groups]), *[head.column(c) for c in by],
                *[batch.column(c).slice(size - 1) for c in by]]
        for c in results:
            kind = kind_of[c]
            made.append(batch.column(c).slice(size - 1) if kind == "previous" else found[f"{kind} {c}"].slice(size - 1))
        made += [head.column(c) for c in plan.runs] + [batch.column(c).slice(size - 1) for c in plan.runs]
        made += [ahead.get(c, pa.nulls(1, summary_arrow.field(c).type)) for c in forward]
        yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(made, summary_arrow)], schema=summary_arrow)

    carry = T.StructType([T.StructField(RANGE, T.IntegerType()), T.StructField("__scan_before", T.LongType()),
                          *[T.StructField(f"{c}_carried", types[c]) for c in results],
                          *[T.StructField(f"{c}_carried", value[c]) for c in forward]])
    carry_arrow = to_arrow_schema(carry)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(batches, summary_arrow).combine_chunks().sort_by(RANGE)
        size = whole.num_rows
        if not size:
            return
        listed = {c: whole.column(c).to_pylist() for c in whole.column_names if c not in (*plan.previous, *forward)}
        key = lambda side, i: tuple(_comparable(listed[f"{side} {c}"][i]) for c in by)
        out: dict[str, list] = {f.name: [None] * size for f in carry_arrow}
        out[RANGE] = listed[RANGE]
        state, owner = None, None
        for i in range(size):
            goes_on = owner is not None and owner == key("first", i)
            if goes_on:
                out["__scan_before"][i] = state["number"]
                for c in results:
                    out[f"{c}_carried"][i] = state[c]
                for c in plan.runs:
                    before, now = state[f"last {c}"], listed[f"first {c}"][i]
                    if _apart(before, now, plan.gaps[c]):
                        out[f"{c}_carried"][i] = state["number"] + 1
            single = goes_on and listed["groups"][i] == 1
            new = {c: listed[c][i] for c in ("number", *plan.running, *plan.latest, *plan.highest, *plan.runs)}
            new |= {f"last {c}": listed[f"last {c}"][i] for c in plan.runs} | {c: i for c in plan.previous}
            if single:
                new["number"] += state["number"]
                for c in plan.running:
                    new[c] = new[c] + state[c]
                for c in plan.latest:
                    new[c] = state[c] if new[c] is None else new[c]
                for c in plan.highest:
                    new[c] = max((x for x in (new[c], state[c]) if x is not None), default=None)
                for c in plan.runs:
                    new[c] = out[f"{c}_carried"][i] if new[c] == 1 else new[c] + state["number"]
            state, owner = new, key("last", i)
        # values of any type are taken from the rows of the summary they stand in
        ahead: dict[str, list] = {c: [None] * size for c in forward}
        for c in forward:
            known = whole.column(c).is_valid().to_pylist()
            place, owner = None, None
            for i in reversed(range(size)):
                ahead[c][i] = place if owner is not None and owner == key("last", i) else None
                own = i if known[i] else None
                if listed["groups"][i] == 1 and own is None:
                    own = ahead[c][i]
                place, owner = own, key("first", i)
        made = []
        for f in carry_arrow:
            source = f.name.removesuffix("_carried")
            if source in plan.previous:
                made.append(whole.column(source).combine_chunks().take(pa.array(out[f.name], pa.int64())))
            elif source in ahead:
                made.append(whole.column(source).combine_chunks().take(pa.array(ahead[source], pa.int64())))
            else:
                made.append(pa.array(out[f.name], f.type))
        yield pa.RecordBatch.from_arrays([_whole(a).cast(f.type) for a, f in zip(made, carry_arrow)], schema=carry_arrow)

    # one row per range
    carried = rows.mapInArrow(summed, summary).repartition(1).mapInArrow(folded, carry)
    out = rows.mapInArrow(walked, local)
    if forward:
        out = _backward(out, tuple(by), forward, [F.desc(c) for c in (*by, *order)])
        if keep_ranges:
            out = out.sortWithinPartitions(*by, *order)
    out = out.join(F.broadcast(carried), RANGE, "left")
    first, number = F.col(FIRST), F.col("__scan_number")
    made = {}
    for c, (kind, name, _) in inputs.items():
        own, inherited = F.col(f"{c}_local"), F.when(first, F.col(f"{c}_carried"))
        if kind == "running":
            made[name] = (own + F.coalesce(inherited, F.lit(0).cast(types[c]))).cast(types[c])
        elif kind == "previous":
            made[name] = F.when(first & (number == 1), F.col(f"{c}_carried")).otherwise(own)
        elif kind == "latest":
            made[name] = F.coalesce(own, inherited)
        elif kind == "highest":
            made[name] = F.greatest(own, inherited)
        elif kind == "run":
            made[name] = F.when(own == 1, F.coalesce(inherited, own)).otherwise(own + F.coalesce(F.when(first, F.col("__scan_before")), F.lit(0)))
        else:
            made[name] = F.coalesce(own, F.when(F.col(LAST), F.col(f"{c}_carried")))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in made]
    return out.select(*kept, *[column.alias(name) for name, column in made.items()], *([RANGE] if keep_ranges else []))


def _whole(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _backward(rows: DataFrame, by: tuple[str, ...], columns: tuple[str, ...], reverse: list[Column]) -> DataFrame:
    """Add `<column>_local`, the first non-null value from the row on in its group and range, and `__last`, whether that
    is the range's last group. The rows are sorted again where they are, the other way round."""
    schema = T.StructType([*rows.schema, T.StructField(LAST, T.BooleanType()), *[T.StructField(f"{c}_local", rows.schema[c].dataType) for c in columns]])
    names, plan = schema.names, _Plan(by, (), (), columns, (), (), {})

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk(plan)
        for batch in _rows_of(batches):
            found, _, last = walk.take(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(last), *[found[f"latest {c}"] for c in columns]], names=names)

    return rows.sortWithinPartitions(*reverse).mapInArrow(walked, schema)


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "n", **kwargs) -> DataFrame:
    """Row numbers 1, 2, ... per group."""
    return scan(df, by, order, running={name: F.lit(1).cast("long")}, **kwargs)


def by_quantiles(df: DataFrame, order: Sequence[str], segments: int, sample: int = 20_000) -> Column:
    """Segment of arbitrary order columns, from cut points of a fixed-size sample.

    The sample is the rows with the smallest hashes, so a recomputed stage
    finds the same cut points. Only `sample` order tuples reach the driver.
    """
    key = F.struct(*order)
    drawn = df.select(key.alias("k")).orderBy(F.xxhash64("k")).limit(sample).orderBy("k").collect()
    if not drawn or segments < 2:
        return F.lit(0).cast("long")
    step = max(1, len(drawn) // segments)
    schema = df.select(*order).schema
    cuts = [
        F.struct(*[F.lit(row.k[f.name]).cast(f.dataType).alias(f.name) for f in schema])
        for row in drawn[step::step][: segments - 1]
    ]

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low).cast("long")
        middle = (low + high) // 2
        return F.when(key < cuts[middle], search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(cuts))


def _hashable(field: T.StructField) -> Column:
    """The column, as JSON where it holds a map or variant at any depth: Spark does not hash those."""
    kind = field.dataType.simpleString()
    column = F.col(f"`{field.name}`")
    return F.to_json(F.struct(column)) if "map<" in kind or "variant" in kind else column


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, name: str = "rank",
                  salts: int = 64) -> DataFrame:
    """The first `n` rows of every group with their rank.

    Up to 1000 rows, Spark limits each map task's groups before the exchange.
    A larger `n` is first cut per salted slice of the group.
    """
    groups = Window.partitionBy(*by).orderBy(*order)
    if n > 1000:
        sliced = df.withColumn("__salt", F.pmod(F.xxhash64(*[_hashable(f) for f in df.schema]), F.lit(salts)))
        slices = Window.partitionBy(*by, "__salt").orderBy(*order)
        df = sliced.withColumn(name, F.row_number().over(slices)).where(F.col(name) <= n).drop(name, "__salt")
    return df.withColumn(name, F.row_number().over(groups)).where(F.col(name) <= n)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the last in `order`."""
    reverse = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(reverse)).where(F.col("__r") == 1).drop("__r")
