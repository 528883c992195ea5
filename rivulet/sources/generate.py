"""Records made from templates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Signs of a random text (fixed values).
ALPHANUMERIC = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def generate(spark: SparkSession, n: int | None = None, key: str = "", value: str = "", topic: str = "generated",
             start: int = 1, step: int = 1, seed: int = 0, int_range: tuple[int, int] = (0, 1000),
             double_range: tuple[float, float] = (0.0, 1.0), string_length: int = 10, ids: DataFrame | None = None,
             rate: int | None = None) -> DataFrame:
    """`n` records, one per row of `ids` (a frame with `id` 0, 1, ...), or an endless stream of `rate` per second.

    Templates may use ${sequence} ${timestamp} ${timestamp_ms} ${uuid}
    ${random_int} ${random_double} ${random_string} ${random_bool} ${partition}
    ${topic}. Random values hash the seed, the row and the template, so a
    recomputed task makes the same record; repeated placeholders of one
    template share a value.
    """
    if rate is not None:
        rows = spark.readStream.format("rate").option("rowsPerSecond", rate).load()
        rows = rows.select(F.col("value").alias("id"), F.col("timestamp").alias("timestamp"))
    else:
        rows = (ids.select("id") if ids is not None else spark.range(n)).withColumn("timestamp", F.current_timestamp())
    sequence = F.col("id") * step + start
    lowest, highest = int_range
    low, high = double_range

    def drawn(name: str, side: str, *more: Column) -> Column:
        return F.xxhash64(F.lit(seed), F.lit(f"{side}:{name}"), F.col("id"), *more)

    def placeholder(name: str, side: str) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(side), F.col("id").cast("string")))
        return {
            "sequence": lambda: sequence.cast("string"),
            "timestamp": lambda: F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0'xxx"),
            "timestamp_ms": lambda: F.unix_millis("timestamp").cast("string"),
            "uuid": lambda: F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
            "random_int": lambda: (F.pmod(drawn(name, side), F.lit(highest - lowest + 1)) + lowest).cast("string"),
            "random_double": lambda: F.format_string(
                "%.6f", F.lit(low) + F.pmod(drawn(name, side), F.lit(1 << 53)).cast("double") / float(1 << 53) * (high - low)),
            "random_string": lambda: F.array_join(
                F.transform(F.sequence(F.lit(1), F.lit(string_length)),
                            lambda i: F.substring(F.lit(ALPHANUMERIC), (F.pmod(drawn(name, side, i), F.lit(len(ALPHANUMERIC))) + 1).cast("int"), F.lit(1))),
                ""),
            "random_bool": lambda: F.when(F.pmod(drawn(name, side), F.lit(2)) == 1, "true").otherwise("false"),
            "partition": lambda: F.lit("0"),
            "topic": lambda: F.lit(topic),
        }[name]()

    known = "sequence|timestamp_ms|timestamp|uuid|random_int|random_double|random_string|random_bool|partition|topic"

    def filled(template: str, side: str) -> Column:
        parts, end = [], 0
        for found in re.finditer(rf"\$\{{({known})\}}", template):
            parts += [F.lit(template[end : found.start()]), placeholder(found.group(1), side)]
            end = found.end()
        return F.concat(*parts, F.lit(template[end:]))

    return rows.select(
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        (filled(key, "key") if key else F.lit(None)).cast("binary").alias("key"),
        filled(value, "value").cast("binary").alias("value"),
        "timestamp",
        F.create_map(
            F.lit("generator.sequence"), sequence.cast("string").cast("binary"),
            F.lit("generator.count"), (F.col("id") + 1).cast("string").cast("binary"),
        ).alias("headers"),
    )
