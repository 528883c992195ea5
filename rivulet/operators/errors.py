"""An error channel: records that fail a step stay in the frame, marked, and leave it as dead letters.

Every step looks at the records without an error only. Failed records keep
their payload and pass through the steps after, so one pass over the input
yields both the results and the failures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.records import as_text, parsed

ERROR = "error"


def _expression(value: str | Column) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _once(column: Column) -> Column:
    """As an array of one, which Spark does not fold into its readers, so that it is computed once."""
    return F.array(column)


def checked(df: DataFrame, need_json: bool = True) -> DataFrame:
    """Open the channel: add `error`, null for records whose payload can be read."""
    bad = F.when(parsed().isNull(), F.lit("payload is not JSON")) if need_json else F.lit(None).cast("string")
    return df.withColumn(ERROR, bad)


def _judged(df: DataFrame, condition: str | Column) -> DataFrame:
    test = _once(_expression(condition))
    good = df.withColumn("json", parsed()).withColumn("__verdict", F.when(F.col(ERROR).isNull(), test)).drop("json")
    undecided = F.col(ERROR).isNull() & F.col("__verdict")[0].isNull()
    return good.withColumn(ERROR, F.when(undecided, F.lit("condition cannot be decided")).otherwise(F.col(ERROR)))


def filter_checked(df: DataFrame, condition: str | Column) -> DataFrame:
    """Keep the records whose condition is true, and the failed ones. A condition that is null is an error.

    The condition may read every column and `json`, the payload as a variant.
    """
    return _judged(df, condition).where(F.col(ERROR).isNotNull() | F.col("__verdict")[0]).drop("__verdict")


def route_checked(df: DataFrame, condition: str | Column, true_topic: str, false_topic: str | None = None) -> DataFrame:
    """Send records to one of two topics; without a false topic the rest is dropped. Failed ones keep their topic."""
    judged, verdict = _judged(df, condition), F.col("__verdict")[0]
    if false_topic is None:
        judged = judged.where(F.col(ERROR).isNotNull() | verdict)
    topic = F.when(F.col(ERROR).isNotNull(), F.col("topic")).when(verdict, F.lit(true_topic)).otherwise(F.lit(false_topic))
    return judged.withColumn("topic", topic).drop("__verdict")


def map_checked(df: DataFrame, value: str | Column) -> DataFrame:
    """Replace the value, as text or bytes; a value that comes out null is an error and stays as it was.

    Use Spark's `try_` functions for what may fail on some records.
    """
    made = df.withColumn("json", parsed()).withColumn("__made", F.when(F.col(ERROR).isNull(), _once(_expression(value)))).drop("json")
    new, failed = F.col("__made")[0], F.col(ERROR)
    kind = df.schema["value"].dataType
    return made.withColumns({
        "value": F.when(failed.isNull() & new.isNotNull(), new.cast(kind)).otherwise(F.col("value")),
        ERROR: F.when(failed.isNull() & new.isNull(), F.lit("value cannot be made")).otherwise(failed),
    }).drop("__made")


def settled(df: DataFrame, policy: str = "deadletter", topic: str = "dead-letter") -> DataFrame:
    """Close the channel: `fail` on the first failure, `skip` failures, or send them to a topic of their own.

    Dead letters keep key, value and `error`, and name the topic they had in
    the header `topic`. Results and dead letters are one frame, so a sink with a
    folder or table per topic writes both in one pass.
    """
    failed = F.col(ERROR).isNotNull()
    if policy == "skip":
        return df.where(~failed).drop(ERROR)
    if policy == "fail":
        stop = F.raise_error(F.concat(F.lit("record failed: "), F.col(ERROR))).cast("boolean")
        return df.where(F.when(failed, stop).otherwise(F.lit(True))).drop(ERROR)
    if policy != "deadletter":
        raise ValueError(f"unknown error policy {policy!r}")
    out = df
    if "headers" in df.columns:
        told = F.create_map(F.lit("topic"), F.coalesce(as_text("topic"), F.lit("")).cast("binary"))
        kept = F.map_filter(F.coalesce(F.col("headers"), F.create_map().cast("map<string,binary>")), lambda k, _: k != "topic")
        out = out.withColumn("headers", F.when(failed, F.map_concat(kept, told)).otherwise(F.col("headers")))
    return out.withColumn("topic", F.when(failed, F.lit(topic)).otherwise(F.col("topic")))
