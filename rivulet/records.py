"""The record shape shared by all operators, and access to its JSON payload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("headers", T.MapType(T.StringType(), T.BinaryType())),
    ]
)


def as_text(name: str | Column) -> Column:
    """A payload column as text, whether it is stored as text or as UTF-8 bytes."""
    column = F.col(name) if isinstance(name, str) else name
    return column.cast("string")


def json_path(path: str) -> str:
    """`a.b` as a JSON path; `.` and the empty path mean the root."""
    steps = [step for step in path.split(".") if step]
    return "$" + "".join(f"['{step}']" for step in steps)


def parsed(value: str | Column = "value") -> Column:
    """The payload as a variant; null when it is empty or not JSON."""
    return F.try_parse_json(as_text(value))


def node_at(json: Column, path: str) -> Column:
    """The JSON node at a dotted path, as a variant."""
    return F.try_variant_get(json, json_path(path), "variant")


def text_at(json: Column, path: str, source: str | Column = "value") -> Column:
    """The node at a dotted path as text; strings lose their quotes, null stays null.

    A variant drops trailing zeros of a fraction, so those numbers are read
    from the source text instead.
    """
    fraction = kind_of(node_at(json, path)).rlike("^(DECIMAL|DOUBLE|FLOAT)")
    written = F.get_json_object(as_text(source), json_path(path))
    return F.when(fraction, written).otherwise(F.try_variant_get(json, json_path(path), "string"))


def kind_of(node: Column) -> Column:
    """Spark's type name of a JSON node: STRING, BIGINT, VOID, ARRAY<...>, OBJECT<...>."""
    return F.schema_of_variant(node)


def as_number(text: Column) -> Column:
    """Text as a double, null unless all of it is a number."""
    tail = F.right(F.trim(text), F.lit(1))
    # Java also reads the suffixed literals 7d and 7f as numbers.
    return F.when(~tail.isin("d", "D", "f", "F"), text.try_cast("double"))


def number_at(json: Column, path: str) -> Column:
    return as_number(F.try_variant_get(json, json_path(path), "string"))


def is_typed(df: DataFrame, path: str) -> bool:
    """Whether a path names a typed column rather than a member of the payload."""
    head = path.split(".")[0]
    return head in df.columns and head not in RECORD.names


def field(df: DataFrame, path: str) -> Column:
    """A typed column when the frame has one, else the text at that path of `value`."""
    if is_typed(df, path):
        return F.col(".".join(f"`{step}`" for step in path.split(".")))
    return F.get_json_object(as_text("value"), json_path(path))


def payload_size() -> Column:
    """Bytes of key and value."""
    return sum(
        (F.coalesce(F.octet_length(name), F.lit(0)) for name in ("key", "value")), F.lit(0)
    ).cast("long")


def unnest(df: DataFrame, kept: Sequence, array: Column | str, position: str, value: str) -> DataFrame:
    """One row per element of an array, with its position.

    From a plain explode Spark infers a filter on the array's size and so
    computes the array twice, once before any exchange below. The outer form
    with a filter on the position computes it once.
    """
    return df.select(*kept, F.posexplode_outer(array).alias(position, value)).where(F.col(position).isNotNull())
