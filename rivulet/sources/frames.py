"""Messages inside captured text and bytes: frames, server-sent events, calendars."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rivulet.functions.text import rows_of
from rivulet.records import unnest


def split_frames(df: DataFrame, col: str = "value", framing: str = "line", delimiter: bytes = b"\n", width: int = 4,
                 big_endian: bool = True, max_size: int | None = None) -> DataFrame:
    """One row per message of each captured byte blob: `frame_index`, `frame`.

    `line` ends at a newline (carriage return stripped, cut at `max_size`),
    `delimiter` at a byte sequence (of an oversized message only the rest after
    each full buffer remains), `length` reads a 1, 2 or 4 byte prefix and fails
    above `max_size`, `raw` is the blob. Empty messages are dropped, except
    length-prefixed ones; an unfinished last message is held back.
    """
    if framing not in ("line", "delimiter", "length", "raw"):
        raise ValueError(f"unknown framing {framing!r}")
    if framing == "length" and width not in (1, 2, 4):
        raise ValueError("a length prefix has 1, 2 or 4 bytes")
    order = "big" if big_endian else "little"

    def lines(data: bytes) -> list[bytes]:
        found = [part[:max_size] for part in data.split(b"\n")[:-1] if part]
        return [part.removesuffix(b"\r") for part in found]

    def delimited(data: bytes) -> list[bytes]:
        found = data.split(delimiter)[:-1]
        if max_size is not None:
            held = [(len(p) + len(delimiter) - 1) % (max_size + 1) + 1 - len(delimiter) for p in found]
            found = [p[len(p) - h :] if h > 0 else b"" for p, h in zip(found, held)]
        return [part for part in found if part]

    def prefixed(data: bytes) -> list[bytes]:
        found, at = [], 0
        while at + width <= len(data):
            size = int.from_bytes(data[at : at + width], order, signed=width == 4)
            if size < 0 or (max_size is not None and size > max_size):
                raise ValueError(f"message length {size} exceeds {max_size}")
            at += width
            if at + size > len(data):
                break
            found.append(data[at : at + size])
            at += size
        return found

    read = {"line": lines, "delimiter": delimited, "length": prefixed, "raw": lambda data: [data]}[framing]

    frame = T.StructType([T.StructField("frame", T.BinaryType())])
    kept = [c for c in df.columns if c != col]
    found = rows_of(df, kept, F.col(col).cast("binary"), lambda data: ((part,) for part in read(data)), frame, "__frames")
    rows = unnest(found, kept, "__frames", "frame_index", "__frame")
    return rows.select(*kept, "frame_index", "__frame.frame")


def parse_sse(df: DataFrame, col: str = "value") -> DataFrame:
    """Events of captured server-sent text: `event_index`, `data`, `event`, `id`.

    Data lines are joined by newlines; comments and events without data are
    dropped; an event counts only once a blank line ended it.
    """
    text = F.regexp_replace(F.col(col).cast("string"), "\r\n?", "\n")
    blocks = F.split(text, "\n\n")
    ended = F.slice(blocks, F.lit(1), F.size(blocks) - 1)
    kept = [c for c in df.columns if c != col]
    rows = unnest(df, kept, ended, "__at", "__block").withColumn("__lines", F.split("__block", "\n"))

    def values(name: str) -> Column:
        own = F.filter("__lines", lambda line: (line == name) | line.startswith(f"{name}:"))
        return F.transform(own, lambda line: F.regexp_replace(F.substring(line, F.lit(len(name) + 2), F.length(line)), "^ ", ""))

    found = rows.withColumns({"__data": values("data"), "__event": values("event"), "__id": values("id")})
    return found.where(F.size("__data") > 0).select(
        *kept, F.col("__at").alias("event_index"), F.array_join("__data", "\n").alias("data"),
        F.try_element_at("__event", F.lit(-1)).alias("event"), F.try_element_at("__id", F.lit(-1)).alias("id"))


def _calendar_time(text: Column) -> Column:
    """`20240131T101500Z` or `20240131` as a timestamp without zone."""
    iso = F.regexp_replace(text, r"^(\d{4})(\d\d)(\d\d)(?:T(\d\d)(\d\d)(\d\d)Z?)?$", "$1-$2-$3T$4:$5:$6")
    return F.regexp_replace(iso, "T::$", "").try_cast("timestamp_ntz")


def _unescaped(text: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(text, r"\\[nN]", "\n"), r"\\([,;])", "$1")
    return F.regexp_replace(plain, r"\\\\", r"\\")


def parse_ics(df: DataFrame, col: str = "value") -> DataFrame:
    """One row per event of each calendar text."""
    text = F.regexp_replace(F.regexp_replace(F.col(col).cast("string"), "\r\n?", "\n"), "\n[ \t]", "")
    bodies = F.regexp_extract_all(text, F.lit("(?s)BEGIN:VEVENT\n(.*?)END:VEVENT"), F.lit(1))
    kept = [c for c in df.columns if c != col]
    rows = unnest(df, kept, bodies, "__at", "__body").withColumn("__lines", F.split("__body", "\n"))

    def every(name: str) -> Column:
        return F.filter("__lines", lambda line: line.rlike(f"(?i)^{name}[:;]"))

    def value(line: Column) -> Column:
        # parameters may quote a colon
        return F.regexp_replace(line, r'^[^:;]+(?:;[^:;=]+=(?:"[^"]*"|[^:;"]*))*:', "")

    def first(name: str) -> Column:
        return value(F.get(every(name), F.lit(0)))

    def parameter(line: Column, name: str) -> Column:
        found = F.regexp_extract(line, f'(?i);{name}=(?:"([^"]*)"|([^:;"]*))', 1)
        bare = F.regexp_extract(line, f'(?i);{name}=(?:"([^"]*)"|([^:;"]*))', 2)
        return F.nullif(F.concat(found, bare), F.lit(""))

    start_line, end_line = F.get(every("DTSTART"), F.lit(0)), F.get(every("DTEND"), F.lit(0))
    attendees = F.transform(
        every("ATTENDEE"),
        lambda line: F.struct(value(line).alias("email"), parameter(line, "CN").alias("name"),
                              parameter(line, "ROLE").alias("role"), parameter(line, "PARTSTAT").alias("status")))
    events = rows.select(
        *kept,
        first("UID").alias("uid"),
        _unescaped(first("SUMMARY")).alias("summary"),
        _unescaped(first("DESCRIPTION")).alias("description"),
        _unescaped(first("LOCATION")).alias("location"),
        _calendar_time(first("DTSTART")).alias("start"),
        _calendar_time(first("DTEND")).alias("end"),
        parameter(start_line, "TZID").alias("start_timezone"),
        parameter(end_line, "TZID").alias("end_timezone"),
        first("DTSTART").rlike(r"^\d{8}$").alias("all_day"),
        first("STATUS").alias("status"),
        _calendar_time(first("CREATED")).alias("created"),
        _calendar_time(first("LAST-MODIFIED")).alias("last_modified"),
        first("SEQUENCE").try_cast("int").alias("sequence"),
        first("TRANSP").alias("transparency"),
        first("PRIORITY").try_cast("int").alias("priority"),
        first("ORGANIZER").alias("organizer"),
        F.nullif(F.array_join(F.transform(every("CATEGORIES"), lambda c: _unescaped(value(c))), ","), F.lit("")).alias("categories"),
        first("RRULE").alias("recurrence_rule"),
        attendees.alias("attendees"),
    )
    changed = F.coalesce("last_modified", "created", "start")
    return events.withColumns({
        "event_key": F.concat(F.coalesce("uid", F.lit("")), F.lit("_"), F.coalesce(F.date_format("start", "yyyyMMddHHmmss"), F.lit(""))),
        "stamp_ms": F.coalesce(F.unix_millis(F.to_utc_timestamp(changed, "UTC").cast("timestamp")), F.lit(0)),
    })


def window_events(events: DataFrame, now: datetime, window_days: int = 30, include_past: bool = False,
                  seen: DataFrame | None = None, since: int | None = None) -> DataFrame:
    """Events overlapping [now, now + window], or any up to then with the past included; not seen, not older than `since`."""
    start = F.coalesce(F.col("start"), F.lit(datetime(1, 1, 1)).cast("timestamp_ntz"))
    test = start <= F.lit(now + timedelta(days=window_days)).cast("timestamp_ntz")
    if not include_past:
        test &= F.coalesce(F.col("end"), start) >= F.lit(now).cast("timestamp_ntz")
    if since is not None:
        test &= F.col("stamp_ms") >= since
    kept = events.where(test)
    return kept if seen is None else kept.join(seen.select("event_key"), "event_key", "left_anti")


def read_ics(spark: SparkSession, path: str, now: datetime, window_days: int = 30, include_past: bool = False,
             seen: DataFrame | None = None, since: int | None = None) -> DataFrame:
    """Events of the calendar files under a path; order by `stamp_ms` for oldest change first."""
    whole = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("source_file"))
    return window_events(parse_ics(whole), now, window_days, include_past, seen, since)
