"""Time-series points in long form: one row per measurement, tag set, field and time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rivulet.operators.ordered import top_per_group

_UNITS = {"s": 1_000_000, "ms": 1_000, "us": 1}


def _floor_div(value: Column, by: int) -> Column:
    """Exact integer division, rounding down."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


def parse_ts(column: Column, precision: str = "ns", numeric: bool = False) -> Column:
    """A timestamp from ISO text (UTC unless it names a zone) or from an epoch in s, ms, us or ns."""
    if numeric:
        epoch = column.cast("long")
        if precision == "ns":
            return F.timestamp_micros(_floor_div(epoch, 1000))
        return F.timestamp_micros(epoch * F.lit(_UNITS[precision]))
    zoned = F.concat(column, F.lit("Z")).try_cast("timestamp")
    day = F.concat(column, F.lit("T00:00:00Z")).try_cast("timestamp")
    return F.coalesce(zoned, day, column.try_cast("timestamp"))


def _time(df: DataFrame, ts_col: str | None, precision: str) -> Column:
    kind = df.schema[ts_col or "timestamp"].dataType
    column = F.col(ts_col or "timestamp")
    if isinstance(kind, T.StringType):
        parsed = parse_ts(column)
    elif isinstance(kind, T.NumericType):
        parsed = parse_ts(column, precision, numeric=True)
    else:
        parsed = column
    # points without a readable time of their own carry the record's time
    if ts_col and ts_col != "timestamp" and "timestamp" in df.columns:
        own = "timestamp_ntz" if isinstance(kind, T.TimestampNTZType) else "timestamp"
        return F.coalesce(parsed, F.col("timestamp").cast(own))
    return parsed


def to_points(df: DataFrame, measurement: str = "", measurement_field: str | None = None, tags: Sequence[str] = (),
              fields: Sequence[str] = (), ts_col: str | None = None, precision: str = "ns") -> DataFrame:
    """Rows as points (measurement, tags, field, ts and one typed value column per kind).

    The measurement is a field's value, else the given name, else the topic.
    Without a field list every other column is a field. Nulls are skipped.
    """
    name = F.lit(measurement or None).cast("string")
    if measurement_field:
        name = F.coalesce(F.col(measurement_field).cast("string"), name)
    name = F.coalesce(name, F.col("topic") if "topic" in df.columns else F.lit("default"))
    tagged = {t.lower() for t in tags}
    wanted = {f.lower() for f in fields}
    reserved = {measurement_field, ts_col, "topic", "timestamp"}

    def value(f: T.StructField) -> Column:
        column, kind = F.col(f"`{f.name}`"), f.dataType
        whole = isinstance(kind, T.IntegralType)
        real = isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType))
        logical = isinstance(kind, T.BooleanType)
        null = F.lit(None)
        text = null if whole or real or logical else (
            F.to_json(column) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else column)
        return F.struct(
            F.lit(f.name).alias("field"),
            (column if whole else null).cast("long").alias("long_value"),
            (column if real else null).cast("double").alias("double_value"),
            (column if logical else null).cast("boolean").alias("bool_value"),
            text.cast("string").alias("string_value"),
            column.isNotNull().alias("set"),
        )

    measured = [
        value(f) for f in df.schema
        if f.name not in reserved and f.name.lower() not in tagged and (not wanted or f.name.lower() in wanted)
    ]
    own = [c for c in df.columns if c.lower() in tagged]
    pairs = [x for c in own for x in (F.lit(c), F.col(c).cast("string"))]
    tag_map = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")
    points = df.select(
        name.alias("measurement"), tag_map.alias("tags"), _time(df, ts_col, precision).alias("ts"), F.inline(F.array(*measured)))
    return points.where("set").drop("set")


def series_key(measurement: Column, tags: Column) -> Column:
    """`measurement:tag value:...` with the tags in name order."""
    ordered = F.array_sort(F.map_entries(tags))
    return F.concat_ws(":", measurement, F.transform(ordered, lambda e: e["value"]))


def range_points(points: DataFrame, start: datetime | None = None, stop: datetime | None = None,
                 after: datetime | None = None, window: timedelta | None = None, now: datetime | None = None,
                 measurement: str | None = None, n: int | None = None) -> DataFrame:
    """Points of [start, stop), or newer than `after`, or of a window ending now; the first `n` of each series."""
    ts = F.col("ts")
    if start is not None and stop is not None:
        points = points.where((ts >= F.lit(start)) & (ts < F.lit(stop)))
    elif after is not None:
        points = points.where(ts > F.lit(after))
    elif window is not None:
        points = points.where(ts >= F.lit((now or datetime.now()) - window))
    if measurement:
        points = points.where(F.col("measurement") == measurement)
    if n is None:
        return points
    series = F.to_json(F.array_sort(F.map_entries("tags")))
    ranked = points.withColumn("__series", series)
    typed = [c for c in ("long_value", "double_value", "string_value") if c in points.columns]
    first = top_per_group(ranked, ["measurement", "__series", "field"], [F.asc("ts"), *[F.asc(c) for c in typed]], n)
    return first.drop("__series", "rank")
