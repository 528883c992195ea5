"""Records and tables as files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rivulet.operators.ordered import numbered
from rivulet.records import field, parsed


def flat_text(df: DataFrame) -> DataFrame:
    """Every column as text: nested values as JSON, bytes as base64."""

    def shown(f: T.StructField) -> Column:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            return F.to_json(column).alias(f.name)
        if isinstance(f.dataType, T.BinaryType):
            return F.base64(column).alias(f.name)
        return column.cast("string").alias(f.name)

    return df.select(*[shown(f) for f in df.schema])


def _limited(df: DataFrame, mode: str, max_records: int | None):
    writer = df.write.mode(mode)
    return writer.option("maxRecordsPerFile", max_records) if max_records else writer


def write_csv(df: DataFrame, path: str, delimiter: str = ",", header: bool = True, mode: str = "append",
              max_records: int | None = None) -> None:
    """Delimited files, each with its header; null is empty; a file rolls after `max_records`."""
    writer = _limited(flat_text(df), mode, max_records)
    writer.options(sep=delimiter, header=header, quote='"', escape='"', nullValue="", emptyValue="").csv(path)


def write_parquet(df: DataFrame, path: str, codec: str = "snappy", row_group_bytes: int | None = None,
                  max_records: int | None = None, as_text: bool = False, mode: str = "append") -> None:
    """Columnar files with types kept; `as_text` writes text only, missing values as empty text."""
    rows = flat_text(df).na.fill("") if as_text else df
    writer = _limited(rows, mode, max_records).option("compression", codec)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def write_json(df: DataFrame, path: str, lines: bool = True, mode: str = "append", max_records: int | None = None) -> None:
    """JSON lines, or one JSON array per file."""
    if lines:
        _limited(df, mode, max_records).json(path)
        return

    def bracketed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sep = "["
        for batch in batches:
            if len(batch):
                out = batch["value"].copy()
                out.iloc[0] = sep + out.iloc[0]
                out.iloc[1:] = "," + out.iloc[1:]
                sep = ","
                yield pd.DataFrame({"value": out})
        yield pd.DataFrame({"value": ["]" if sep == "," else "[]"]})

    rows = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    made = rows.mapInPandas(bracketed, "value string")
    if rows.isEmpty():  # a frame without partitions would write a file without an array
        made = df.sparkSession.createDataFrame([("[]",)], "value string").coalesce(1)
    made.write.mode(mode).text(path)


def write_text(df: DataFrame, path: str, value: str = "value", mode: str = "append") -> None:
    """One line per record."""
    df.select(F.col(value).cast("string").alias("value")).write.mode(mode).text(path)


_FOLDERS = {"time": ["day", "hour"], "day": ["day"], "partition": ["partition"]}


def partition_columns(df: DataFrame, by: str = "time") -> DataFrame:
    """Add the folder columns: topic, then day and hour (`time`), `day`, `partition`, or a payload field.

    A field value keeps letters, digits and `-_.`; a value that is missing,
    empty, nested or not JSON goes to `unknown`.
    """
    if by == "time":
        return df.withColumns({"day": F.date_format("timestamp", "yyyy-MM-dd"), "hour": F.date_format("timestamp", "HH")})
    if by == "day":
        return df.withColumn("day", F.date_format("timestamp", "yyyy-MM-dd"))
    if by == "partition":
        return df
    text = field(df, by).cast("string")
    if by not in df.columns:
        usable = parsed().isNotNull() & ~F.ltrim(text).rlike(r"^[\[{]")
        text = F.when(usable, text)
    clean = F.regexp_replace(text, r"[^A-Za-z0-9._-]", "_")
    return df.withColumn(by if by not in df.columns else f"{by}_folder", F.when(F.length(clean) > 0, clean).otherwise("unknown"))


def write_partitioned(df: DataFrame, path: str, by: str = "time", fmt: str = "json", mode: str = "append",
                      max_records: int | None = None, files_per_folder: int | None = None) -> None:
    """Files under topic and time, partition or field folders.

    Each task writes its own files, so a hot folder is written by many tasks.
    `files_per_folder` exchanges rows first, spreading every folder over that
    many tasks, where many folders would give too many small files.
    """
    staged = partition_columns(df, by)
    folders = ["topic"] + _FOLDERS.get(by, [by if by not in df.columns else f"{by}_folder"])
    if files_per_folder:
        own = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
        staged = staged.withColumn("__salt", F.pmod(F.xxhash64(*own), F.lit(files_per_folder)))
        staged = staged.repartition(*folders, "__salt").drop("__salt")
    for name in ("key", "value"):
        if fmt == "json" and name in staged.columns:
            staged = staged.withColumn(name, F.col(name).cast("string"))
    if fmt == "json" and "headers" in staged.columns:
        staged = staged.withColumn("headers", F.transform_values("headers", lambda _, v: v.cast("string")))
    _limited(staged, mode, max_records).partitionBy(*folders).format(fmt).save(path)


def _escaped(text: Column) -> Column:
    plain = F.regexp_replace(text, r"([\\,;])", r"\\$1")
    return F.regexp_replace(plain, "\r?\n", r"\\n")


def _folded(line: Column) -> Column:
    return F.regexp_replace(line, "(.{73})(?=.)", "$1\r\n ")


def to_ics(df: DataFrame, calendar: str = "Events", product: str = "-//rivulet//EN", default_minutes: int = 60,
           max_events: int = 1000, by: str = "topic", order_by: str = "offset") -> DataFrame:
    """Event rows (uid, summary, start, ...) as calendar texts of at most `max_events` events each."""
    names = set(df.columns)

    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), _folded(F.concat(F.lit(f"{name}:"), value)))

    def text(name: str) -> Column:
        return _escaped(F.col(name).cast("string")) if name in names else F.lit(None).cast("string")

    def stamp(value: Column) -> Column:
        return F.date_format(value, "yyyyMMdd'T'HHmmss")

    start = F.coalesce(F.col("start"), F.current_timestamp().cast("timestamp_ntz")) if "start" in names else F.current_timestamp()
    end = start + F.make_dt_interval(mins=F.lit(default_minutes))
    end = F.coalesce(F.col("end"), end) if "end" in names else end
    uid = F.col("uid").cast("string") if "uid" in names else F.col("key").cast("string")
    lines = [
        F.lit("BEGIN:VEVENT"), line("UID", F.coalesce(uid, F.uuid())), line("SUMMARY", text("summary")),
        line("DESCRIPTION", text("description")), line("LOCATION", text("location")), line("DTSTART", stamp(start)),
        line("DTEND", stamp(end)), line("STATUS", text("status")), line("PRIORITY", text("priority")),
        line("CATEGORIES", F.col("categories").cast("string") if "categories" in names else F.lit(None).cast("string")),
        line("CREATED", stamp(F.coalesce(F.col("created"), F.current_timestamp().cast("timestamp_ntz")))) if "created" in names else F.lit(None),
        F.lit("END:VEVENT"),
    ]
    events = numbered(df, [by], [order_by]).select(
        by, F.col(order_by).alias("at"), F.floor((F.col("n") - 1) / max_events).alias("file"), F.concat_ws("\r\n", *lines).alias("event"))
    files = events.groupBy(by, "file").agg(F.array_sort(F.collect_list(F.struct("at", "event"))).alias("events"))
    body = F.array_join(F.transform("events", lambda e: e["event"]), "\r\n")
    head = "\r\n".join(["BEGIN:VCALENDAR", "VERSION:2.0", f"PRODID:{product}", f"X-WR-CALNAME:{calendar}", ""])
    return files.select(by, "file", F.size("events").alias("events"), F.concat(F.lit(head), body, F.lit("\r\nEND:VCALENDAR\r\n")).alias("value"))


def write_ics(df: DataFrame, path: str, mode: str = "append", **options) -> None:
    """Calendar files, one calendar each."""
    calendars = to_ics(df, **options).select("value")
    calendars.write.mode(mode).option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)
