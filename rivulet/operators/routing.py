"""Filtering, routing, mapping, splitting and merging of records."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rivulet.functions.rows import arrow_batch, arrow_schema, python_rows
from rivulet.records import as_text, field, json_path, kind_of, node_at, parsed, text_at, unnest


def _expression(condition: str | Column) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def _with_json(df: DataFrame) -> DataFrame:
    return df.withColumn("json", parsed())


def filter_records(df: DataFrame, condition: str | Column) -> DataFrame:
    """Keep records whose condition is true.

    The condition may read every record column and `json`, the payload as a
    variant (null when the payload is not JSON). Null drops the record.
    """
    return _with_json(df).where(_expression(condition)).drop("json")


def if_route(df: DataFrame, condition: str | Column, true_topic: str, false_topic: str | None = None,
             errors: bool = False) -> DataFrame:
    """Send records to one of two topics; without a false topic the rest is dropped.

    A condition that cannot be decided (null) is an error, not false: such
    records are left out, or kept with a null topic when `errors` is set.
    """
    test = _expression(condition)
    # the verdict is an array of one, which Spark does not fold into its readers: the payload is parsed once
    judged = _with_json(df).withColumn("__verdict", F.array(test)).drop("json")
    verdict = F.col("__verdict")[0]
    keep = F.lit(True)
    if not errors:
        keep = verdict.isNotNull() if false_topic else F.coalesce(verdict, F.lit(False))
    elif not false_topic:
        keep = F.coalesce(verdict, F.lit(True))
    topic = F.when(verdict, F.lit(true_topic)).when(~verdict, F.lit(false_topic or None))
    return judged.where(keep).withColumn("topic", topic).drop("__verdict")


def switch_route(df: DataFrame, path: str, cases: Mapping[str, str] | str, default: str | None = None) -> DataFrame:
    """Send records to the topic of the string found at `path`, compared without case."""
    if isinstance(cases, str):
        pairs = [part.split(":", 1) for part in cases.split(",") if ":" in part]
        cases = {value.strip(): topic.strip() for value, topic in pairs}
    targets = {value.lower(): topic for value, topic in cases.items()}
    node = node_at(F.col("json"), path)
    found = F.when(kind_of(node) == "STRING", F.lower(text_at(F.col("json"), path)))
    topic = F.lit(default or None).cast("string")
    if targets:
        table = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
        topic = F.coalesce(F.try_element_at(table, found), topic)
    return _with_json(df).withColumn("topic", topic).drop("json").where(F.col("topic").isNotNull())


def map_records(df: DataFrame, value: str | Column, key: str | Column | None = None) -> DataFrame:
    """Replace the value, and the key if asked. Text and bytes stay as they are,
    null becomes empty, anything else becomes JSON."""
    staged = _with_json(df).withColumn("__value", _expression(value))
    if key is not None:
        staged = staged.withColumn("__key", _expression(key))
    kinds = dict(staged.dtypes)

    def encoded(name: str) -> Column:
        if kinds[name] in ("string", "binary"):
            return F.col(name)
        if kinds[name].startswith(("struct", "map", "array", "variant")):
            return F.to_json(name)
        return F.col(name).cast("string")

    staged = staged.withColumn("value", F.coalesce(encoded("__value").cast("binary"), F.lit(b"")))
    if key is not None:
        staged = staged.withColumn("key", encoded("__key").cast("binary"))
    return staged.drop("json", "__value", "__key")


def split(df: DataFrame, path: str = ".", include_index: bool = False) -> DataFrame:
    """One record per element of the JSON array at `path`; other records pass unchanged."""
    node = node_at(parsed(), path)
    staged = df.withColumn("__node", node)
    # the parse stays in its own projection, so it happens once per record
    is_array = kind_of(F.col("__node")).startswith("ARRAY")
    elements = F.col("__node").try_cast("array<variant>")
    texts = F.transform(
        elements,
        lambda e: F.when(e.isNull() | F.is_variant_null(e), F.lit("null"))
        .when(kind_of(e) == "STRING", F.to_json(e))
        .otherwise(F.to_json(e)),
    )
    whole = F.array(as_text("value"))
    pieces = F.when(is_array, texts).otherwise(whole)
    kept = [*[c for c in df.columns if c != "value"], is_array.alias("__array")]
    out = unnest(staged, kept, pieces, "__index", "value")
    if include_index:
        mark = F.create_map(F.lit("_index"), F.col("__index").cast("string").cast("binary"))
        headers = F.coalesce(F.col("headers"), F.create_map().cast("map<string,binary>"))
        others = F.map_filter(headers, lambda k, _: k != "_index")
        out = out.withColumn(
            "headers", F.when(F.coalesce("__array", F.lit(False)), F.map_concat(others, mark)).otherwise(F.col("headers"))
        )
    kind = dict(df.dtypes)["value"]
    return out.withColumn("value", F.col("value").cast(kind)).select(*df.columns)


def merge(frames: Mapping[str, DataFrame] | Sequence[DataFrame], topic: str | None = None,
          add_source: bool = False) -> DataFrame:
    """Union several record frames into one stream, optionally noting where each came from."""
    named = frames if isinstance(frames, Mapping) else {str(i): f for i, f in enumerate(frames)}
    out = None
    for name, frame in named.items():
        if add_source:
            origin = F.col("topic") if "topic" in frame.columns else F.lit(name)
            frame = frame.withColumn("_source_topic", origin)
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return out.withColumn("topic", F.lit(topic)) if topic else out


def flat_map(df: DataFrame, fn: Callable[[dict], Iterator[dict]], schema: str | T.StructType) -> DataFrame:
    """Zero or more output rows per record from a Python function over a record's dict."""
    result = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = arrow_schema(result)

    def run(batches):
        for batch in batches:
            rows = [out for record in python_rows(batch) for out in fn(record)]
            if rows:
                yield arrow_batch(rows, kinds)

    return df.mapInArrow(run, result)


def guarded(df: DataFrame, fn: Callable[[dict], Iterator[dict]], schema: str | T.StructType,
            on_error: str = "fail", carry: Sequence[str] = ("key", "value")) -> DataFrame:
    """`flat_map` with an error policy: `fail`, `skip`, or `deadletter`.

    With `deadletter`, a failed record becomes one row holding its original
    `carry` columns and `error`, `error_type`; good rows have both null.
    """
    if on_error not in ("fail", "skip", "deadletter"):
        raise ValueError(f"unknown error policy {on_error!r}")
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if on_error != "deadletter":
        result = out
    else:
        originals = [T.StructField(f"original_{f.name}", f.dataType) for f in df.schema if f.name in carry]
        errors = [T.StructField("error", T.StringType()), T.StructField("error_type", T.StringType())]
        result = T.StructType([*out.fields, *originals, *errors])
    kinds = arrow_schema(result)

    def run(batches):
        for batch in batches:
            rows = []
            for record in python_rows(batch):
                try:
                    made = list(fn(record))
                except Exception as problem:
                    if on_error == "fail":
                        raise
                    made = []
                    if on_error == "deadletter":
                        made = [{**{f"original_{c}": record[c] for c in carry},
                                 "error": str(problem), "error_type": type(problem).__name__}]
                rows.extend(made)
            if rows:
                yield arrow_batch(rows, kinds)

    return df.mapInArrow(run, result)


def dead_letters(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the result of `guarded(..., 'deadletter')` into good rows and failures."""
    failed = ["error", "error_type", *[c for c in tagged.columns if c.startswith("original_")]]
    return tagged.where("error_type IS NULL").drop(*failed), tagged.where("error_type IS NOT NULL").select(*failed)


def for_each(df: DataFrame, fn: Callable[[dict], None]) -> None:
    """Run a function for its effect on every record, on the executors."""

    def run(rows):
        for row in rows:
            fn(row.asDict(recursive=True))

    df.foreachPartition(run)


_PLACEHOLDER = re.compile(r"\$\{([\w.]+)\}")


def _render(df: DataFrame, template: str, resolve: Callable[[str], Column]) -> Column:
    parts: list[Column] = []
    end = 0
    for found in _PLACEHOLDER.finditer(template):
        if found.start() > end:
            parts.append(F.lit(template[end : found.start()]))
        parts.append(F.coalesce(resolve(found.group(1)).cast("string"), F.lit("")))
        end = found.end()
    if end < len(template):
        parts.append(F.lit(template[end:]))
    return F.concat(*parts) if parts else F.lit("")


def render(df: DataFrame, template: str, into: str = "text") -> DataFrame:
    """Fill `${...}` from the record columns or, by dotted path, from string fields of the payload."""
    own = [c for c in ("topic", "partition", "offset", "timestamp", "key", "value") if c in df.columns]

    def resolve(name: str) -> Column:
        if name in own:
            return as_text(name)
        node = node_at(F.col("__json"), name)
        return F.when(kind_of(node) == "STRING", text_at(F.col("__json"), name))

    return df.withColumn("__json", parsed()).withColumn(into, _render(df, template, resolve)).drop("__json")


def map_topic(df: DataFrame, template: str, prefix: str = "", suffix: str = "", into: str = "topic") -> DataFrame:
    """Target topic from a template over the frame's columns, e.g. `${schema}.${table}`."""

    def resolve(name: str) -> Column:
        return F.col(name.removeprefix("kafka.") if name not in df.columns else name)

    return df.withColumn(into, F.concat(F.lit(prefix), _render(df, template, resolve), F.lit(suffix)))


def project_paths(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Named payload values, one column each as variant; without a mapping the payload is `input`."""
    staged = df.withColumn("__json", parsed())
    chosen = {name: node_at(F.col("__json"), path) for name, path in mapping.items()} if mapping else {"input": F.col("__json")}
    return staged.withColumns(chosen).drop("__json")


def fnv1a(column: Column) -> Column:
    """32-bit FNV-1a of a text or binary column, as a long."""
    digits = F.split(F.regexp_replace(F.hex(column.cast("binary")), "(..)(?!$)", "$1,"), ",")
    # offset basis and prime of the 32-bit variant (fixed values)
    return F.aggregate(
        digits,
        F.lit(2166136261).cast("long"),
        lambda h, b: (h.bitwiseXOR(F.conv(b, 16, 10).cast("long")) * F.lit(16777619)).bitwiseAND(F.lit(0xFFFFFFFF)),
    )


def assign_partition(df: DataFrame, n: int, into: str = "partition") -> DataFrame:
    """Keyed records stick to the FNV-1a partition of their key; the rest spread evenly by offset."""
    key = F.col("key").cast("binary")
    spread = F.pmod(F.col("offset"), F.lit(n))
    return df.withColumn(into, F.when(F.octet_length(key) > 0, fnv1a(key) % n).otherwise(spread).cast("int"))


def partition_key(df: DataFrame, key_field: str | None = None, into: str = "partition_key") -> DataFrame:
    """Partition key: a payload field, else the first field of a JSON key, else the key text,
    else `topic-partition-offset`."""
    choices = []
    if key_field:
        choices.append(text_at(parsed(), key_field))
    key = as_text("key")
    members = F.json_object_keys(key)
    first = F.get(members, F.lit(0))
    # dynamic field name: take the first entry of the key read as a string map
    entry = F.get(F.map_values(F.from_json(key, "map<string,string>")), F.lit(0))
    choices.append(F.when(first != "", entry))
    choices.append(F.when((F.length(key) > 0) & members.isNull(), key))
    choices.append(F.concat_ws("-", "topic", "partition", "offset"))
    return df.withColumn(into, F.coalesce(*choices))


def message_filter(df: DataFrame, subject: str | None = None, sender: str | None = None, since=None,
                   unseen: bool = False) -> DataFrame:
    """Messages whose subject and sender contain a text (any case), newer than a date, not yet seen."""
    test = F.lit(True)
    if subject:
        test &= F.contains(F.lower("subject"), F.lit(subject.lower()))
    if sender:
        test &= F.contains(F.lower("sender"), F.lit(sender.lower()))
    if since is not None:
        test &= F.col("date") >= F.lit(since)
    if unseen:
        test &= ~F.col("seen")
    return df.where(test)


def project_payload(df: DataFrame, fields: Sequence[str] | None = None, vector: str = "vector") -> DataFrame:
    """The payload's members as a string-to-variant map without the vector, plus record metadata."""
    members = parsed().try_cast("map<string,variant>")
    kept = F.map_filter(
        members, lambda k, _: (k != vector) & (k.isin(*fields) if fields else F.lit(True))
    )
    stamp = F.unix_millis(F.col("timestamp").cast("timestamp"))
    return df.select(
        kept.alias("payload"),
        F.col("topic").alias("_topic"),
        F.col("partition").alias("_partition"),
        F.col("offset").alias("_offset"),
        stamp.alias("_timestamp"),
    )


def guid_of(text: Column) -> Column:
    """Stable id of a text: first 16 bytes of its SHA-256, the first three groups byte-reversed."""
    digest = F.sha2(text, 256)

    def part(*positions: int) -> Column:
        return F.concat(*[F.substring(digest, 2 * p + 1, 2) for p in positions])

    return F.concat_ws(
        "-", part(3, 2, 1, 0), part(5, 4), part(7, 6), part(8, 9), part(10, 11, 12, 13, 14, 15)
    )


_UUID = r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"


def stable_id(df: DataFrame, strategy: str = "field", path: str | None = None, into: str = "id") -> DataFrame:
    """Record id by `field` (integers and UUIDs kept, else hashed), by `key`, or `random`."""
    if strategy == "field" and path:
        node = node_at(F.col("__json"), path)
        text = text_at(F.col("__json"), path)
        chosen = (
            F.when(kind_of(node) == "BIGINT", text)
            .when(text.rlike(_UUID), F.lower(text))
            .when(text.isNotNull(), guid_of(text))
            .otherwise(F.uuid())
        )
    elif strategy == "key":
        chosen = F.when(F.col("key").isNotNull(), guid_of(as_text("key"))).otherwise(F.uuid())
    else:
        chosen = F.uuid()
    return df.withColumn("__json", parsed()).withColumn(into, chosen).drop("__json")


def doc_id(df: DataFrame, strategy: str = "auto", fields: Sequence[str] = (), delimiter: str = "_",
           into: str = "doc_id") -> DataFrame:
    """Document id: none, the key, one field, or the non-null fields joined."""
    if strategy == "key":
        chosen = as_text("key")
    elif strategy == "field":
        chosen = field(df, fields[0]).cast("string")
    elif strategy == "composite":
        values = [field(df, f).cast("string") for f in fields]
        joined = F.concat_ws(delimiter, *values)
        chosen = F.when(F.coalesce(*values).isNotNull(), joined)
    else:
        chosen = F.lit(None).cast("string")
    return df.withColumn(into, chosen)


def index_name(df: DataFrame, strategy: str = "topic", pattern: str = "${topic}", path: str | None = None,
               time_format: str = "yyyy.MM.dd", into: str = "index") -> DataFrame:
    """Target index: a fixed name, a topic pattern, topic and time, or a field's value else the topic."""
    if strategy == "static":
        chosen = F.lit(pattern)
    elif strategy == "time":
        chosen = F.concat("topic", F.lit("-"), F.date_format("timestamp", time_format))
    elif strategy == "field":
        chosen = F.coalesce(field(df, path).cast("string"), F.col("topic"))
    else:
        chosen = _render(df, pattern, F.col)
    return df.withColumn(into, chosen)
