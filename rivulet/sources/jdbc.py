"""Tables and queries of a remote database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              partition_column: str | None = None, lower: int | str | None = None, upper: int | str | None = None,
              partitions: int = 8, fetch_size: int = 10_000, **options) -> DataFrame:
    """A table or query. Filters, columns and limits are pushed to the database.

    With `partition_column` and its bounds the read is split into ranges; the
    bounds only shape the ranges, rows outside them are read too.
    """
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    reader = spark.read.format("jdbc").options(url=url, fetchsize=fetch_size, **options)
    if partition_column is None:
        return (reader.option("dbtable", table) if table else reader.option("query", query)).load()
    source = table or f"({query}) source"
    return reader.options(
        dbtable=source, partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions
    ).load()
