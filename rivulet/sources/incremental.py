"""Reading a table in steps: cursors, marks, pages and key ranges.

Every cursor is a predicate plus an order over a DataFrame, so it reaches the
scan (or the remote database) as a pushed filter. The mark of a step is an
aggregate over the rows it returned and is stored only after they are written.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from rivulet.operators.ordered import top_per_group


def after(cols: Sequence[str], last: Sequence[Any]) -> Column:
    """Rows behind `last` in the lexicographic order of `cols`."""
    test = F.lit(False)
    for i in reversed(range(len(cols))):
        here, value = F.col(cols[i]), F.lit(last[i])
        test = (here > value) | ((here == value) & test) if i < len(cols) - 1 else here > value
    return test


def incremental(df: DataFrame, mode: str = "timestamp+incrementing", *, id_col: str | None = None,
                ts_col: str | None = None, cols: Sequence[str] = (), last: Any = None, last_id: Any = None,
                limit: int | None = None, seen: DataFrame | None = None, group_col: str | None = None,
                marks: DataFrame | None = None, default: Any = None) -> DataFrame:
    """Rows after the stored cursor, in cursor order.

    Modes: `bulk`, `incrementing` (id), `timestamp`, `timestamp+incrementing`
    (tie-safe), `inclusive` (timestamp at or after the mark, minus ids already
    seen there) and `keyset` (lexicographic over `cols`). With `group_col`,
    `marks` holds one cursor per group.
    """
    if mode == "bulk":
        order, test = list(cols) or [id_col or df.columns[0]], None
    elif mode == "incrementing":
        order, test = [id_col], None if last_id is None else F.col(id_col) > F.lit(last_id)
    elif mode == "timestamp" and group_col:
        return _per_group(df, ts_col, group_col, marks, default)
    elif mode == "timestamp":
        order, test = [ts_col], None if last is None else F.col(ts_col) > F.lit(last)
        order += [id_col] if id_col else []
    elif mode == "timestamp+incrementing":
        order = [ts_col, id_col]
        test = None if last is None else after(order, [last, last_id])
    elif mode == "inclusive":
        order, test = [ts_col, id_col], None if last is None else F.col(ts_col) >= F.lit(last)
        if seen is not None:
            df = df.join(seen.select(id_col, F.lit(last).cast(df.schema[ts_col].dataType).alias(ts_col)).distinct(), [id_col, ts_col], "left_anti")
    elif mode == "keyset":
        order, test = list(cols), None if last is None else after(cols, last)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    rows = df if test is None else df.where(test)
    return rows if limit is None else rows.orderBy(*order).limit(limit)


def _per_group(df: DataFrame, ts_col: str, group_col: str, marks: DataFrame, default: Any) -> DataFrame:
    """Each group's rows newer than that group's mark; Spark broadcasts the marks only while they are small."""
    cursor = marks.select(group_col, F.col("mark").alias("__mark"))
    start = F.coalesce(F.col("__mark"), F.lit(default).cast(dict(df.dtypes)[ts_col]))
    newer = start.isNull() | (F.col(ts_col) > start)
    return df.join(cursor, group_col, "left").where(newer).drop("__mark")


def mark(rows: DataFrame, *cols: str, group_col: str | None = None) -> DataFrame:
    """The cursor after a step: the largest (cols) tuple returned, per group if asked."""
    top = F.max(F.struct(*cols)).alias("mark") if len(cols) > 1 else F.max(cols[0]).alias("mark")
    return rows.groupBy(group_col).agg(top) if group_col else rows.agg(top)


def observed(rows: DataFrame, *cols: str) -> tuple[DataFrame, Callable[[], Any]]:
    """The rows, and a function that gives the cursor after them once they have been written.

    The cursor is taken from the rows as they pass, not by another read: what
    comes into the table meanwhile lies behind it and is read the next time.
    """
    seen = Observation()
    top = F.max(F.struct(*cols)) if len(cols) > 1 else F.max(cols[0])
    return rows.observe(seen, top.alias("mark")), lambda: seen.get["mark"]


def write_marked(rows: DataFrame, write: Callable[[DataFrame], None], store: str, source: str, *cols: str) -> Any:
    """Write rows and save the cursor after them, from one pass. A failed write leaves the cursor where it was."""
    passing, cursor = observed(rows, *cols)
    write(passing)
    value = cursor()
    if value is not None:
        save_mark(rows.sparkSession, store, source, value)
    return value


def initial_mark(store: DataFrame | None, source: str, now: datetime, lookback_seconds: int) -> datetime:
    """The stored mark of a source, or `now` minus the lookback on the first run."""
    row = None if store is None else store.where(F.col("source") == source).agg(F.max("mark").alias("m")).first()
    return row.m if row and row.m is not None else now - timedelta(seconds=lookback_seconds)


def save_mark(spark: SparkSession, path: str, source: str, value: Any) -> None:
    """Append the new mark of a source; the largest one counts."""
    spark.createDataFrame([(source, value)], ["source", "mark"]).write.mode("append").parquet(path)


def page(df: DataFrame, sort_cols: Sequence[str], after_values: Sequence[Any] | None, size: int) -> DataFrame:
    """One page of a stable sort, resuming behind the last sort values."""
    rows = df if after_values is None else df.where(after(sort_cols, after_values))
    return rows.orderBy(*sort_cols).limit(size)


def rowkey_scan(cells: DataFrame, prefix: str | None = None, start: str | None = None, end: str | None = None,
                resume_after: str | None = None, families: Sequence[str] | None = None,
                columns: Sequence[str] | None = None) -> DataFrame:
    """Latest cell per (row, family, column) of a key range: prefix, or start inclusive to end exclusive."""
    test = F.lit(True)
    if prefix is not None:
        test &= F.col("row_key").startswith(prefix)
    if start is not None:
        test &= F.col("row_key") >= start
    if end is not None:
        test &= F.col("row_key") < end
    if resume_after is not None:
        test &= F.col("row_key") > resume_after
    if families:
        test &= F.col("family").isin(*families)
    if columns:
        test &= F.col("column").isin(*columns)
    newest = top_per_group(cells.where(test), ["row_key", "family", "column"], [F.desc("ts"), F.desc("value")], 1)
    return newest.drop("rank")


def odata(df: DataFrame, select: Sequence[str] | None = None, expand: Mapping[str, tuple[DataFrame, str]] | None = None,
          filter: str | None = None, orderby: Sequence[str] = (), top: int | None = None) -> DataFrame:
    """Project, filter, order and limit an entity set and expand its related entities.

    `expand` maps a name to (entities, join condition or column). The related
    entity becomes a struct column; a to-many relation yields one row per
    related entity instead of one nested array, so no parent grows unbounded.
    """
    rows = df.where(filter) if filter else df
    if top is not None:
        rows = rows.orderBy(*orderby).limit(top)
    names = list(select or df.columns)
    for name, (entities, on) in (expand or {}).items():
        related = entities.select(F.struct(*entities.columns).alias(name))
        keys = on if isinstance(on, tuple) else (on, on)
        rows = rows.join(related, rows[keys[0]] == related[name][keys[1]], "left")
        names.append(name)
    return rows.select(*names)


_COMPARE = {
    "eq": lambda c, v: c == v, "==": lambda c, v: c == v,
    "neq": lambda c, v: c != v, "!=": lambda c, v: c != v,
    "gt": lambda c, v: c > v, ">": lambda c, v: c > v,
    "gte": lambda c, v: c >= v, ">=": lambda c, v: c >= v,
    "lt": lambda c, v: c < v, "<": lambda c, v: c < v,
    "lte": lambda c, v: c <= v, "<=": lambda c, v: c <= v,
}


_INTEGER = re.compile(r"[+-]?[0-9]+")
_NUMBER = re.compile(r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?")


def _resolved(name: str, schema: T.StructType) -> tuple[Column, T.DataType] | None:
    """The column at a dotted path and its type; names agree as Spark's do, without regard to case."""
    kind: T.DataType = schema
    steps = []
    whole = next((f for f in schema.fields if f.name.lower() == name.lower()), None)
    for step in [name] if whole else name.split("."):
        found = [f for f in kind.fields if f.name.lower() == step.lower()] if isinstance(kind, T.StructType) else []
        found = [f for f in found if f.name == step] or found
        if len(found) != 1:
            return None
        steps.append(found[0].name)
        kind = found[0].dataType
    return F.col(".".join(f"`{step}`" for step in steps)), kind


def _number(value: int | float) -> Column:
    """A number as a literal; whole ones beyond 64 bits as decimals, beyond 38 digits as doubles."""
    if isinstance(value, float) or -(1 << 63) <= value < 1 << 63:
        return F.lit(value)
    if abs(value) < 10**38:
        return F.lit(str(value)).cast("decimal(38,0)")
    return F.lit(str(value)).cast("double")


def literal(text: str) -> Any:
    """A filter value: integer, else double, else boolean, else text."""
    if _INTEGER.fullmatch(text):
        return int(text)
    if _NUMBER.fullmatch(text):
        return float(text)
    return {"true": True, "false": False}.get(text.lower(), text)


def predicate(text: str, schema: T.StructType) -> Column | None:
    """`field:op:value` as a filter; anything else filters nothing.

    A value of another kind than the column matches nothing: a number only
    compares with numbers, text only with text, dates and times. Dotted names
    lead into structs; a name that the schema lacks matches nothing.
    """
    parts = text.split(":", 2)
    if len(parts) < 3 or parts[1].strip().lower() not in _COMPARE:
        return None
    field, value = _resolved(parts[0].strip(), schema), literal(parts[2].strip())
    if field is None:
        return F.lit(False)
    column, kind = field
    number, truth = isinstance(value, (int, float)) and not isinstance(value, bool), isinstance(value, bool)
    if isinstance(kind, T.NumericType) != number or isinstance(kind, T.BooleanType) != truth:
        return F.lit(False)
    if not number and not truth and not isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(False)
    given = _number(value) if number else F.lit(value)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        given = given.try_cast(kind)
    return _COMPARE[parts[1].strip().lower()](column, given)


def query(df: DataFrame, where: str | None = None, order_by: str | None = None, descending: bool = False,
          limit: int | None = None) -> DataFrame:
    """A collection query of one predicate, one order and a limit."""
    test = predicate(where, df.schema) if where else None
    rows = df if test is None else df.where(test)
    if order_by:
        rows = rows.orderBy(F.desc(order_by) if descending else F.asc(order_by))
    return rows if limit is None else rows.limit(limit)


def recent(df: DataFrame, n: int, from_offset: int | None = None, limit: int | None = None) -> DataFrame:
    """The last `n` records of every topic; from an offset on, the first `limit` of those."""
    last = top_per_group(df, ["topic"], [F.desc("offset"), F.desc("partition")], n).drop("rank")
    if from_offset is None:
        return last
    tail = last.where(F.col("offset") >= from_offset)
    if limit is None:
        return tail
    return top_per_group(tail, ["topic"], [F.asc("offset"), F.asc("partition")], limit).drop("rank")
