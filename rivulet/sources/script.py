"""Records from user code, as a Spark data source."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

Script = Callable[[int], Iterator[tuple]]


def register_script(spark: SparkSession, name: str, fn: Script, ddl: str) -> None:
    """Make `fn` readable as `spark.read.format(name)` or `spark.readStream.format(name)`.

    In a batch read `fn` gets each partition number (option `partitions`). In a
    stream it gets the tick number; a restarted query goes on after the last
    committed tick.
    """

    class Batch(DataSourceReader):
        def __init__(self, parts: int):
            self.parts = parts

        def partitions(self):
            return [InputPartition(i) for i in range(self.parts)]

        def read(self, partition):
            yield from fn(partition.value)

    class Stream(DataSourceStreamReader):
        def __init__(self, ticks: int):
            self.ticks, self.at = ticks, 0

        def initialOffset(self):
            return {"tick": 0}

        def latestOffset(self):
            self.at = min(self.at + 1, self.ticks)
            return {"tick": self.at}

        def partitions(self, start, end):
            self.at = max(self.at, end["tick"])
            return [InputPartition(i) for i in range(start["tick"], end["tick"])]

        def read(self, partition):
            yield from fn(partition.value)

        def commit(self, end):
            pass

    class ScriptSource(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return ddl

        def reader(self, schema):
            return Batch(int(self.options.get("partitions", "1")))

        def streamReader(self, schema):
            return Stream(int(self.options.get("ticks", str(2**62))))

    spark.dataSource.register(ScriptSource)
