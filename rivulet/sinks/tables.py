"""Tables kept by write modes: versioned folders, bulk loads and JDBC targets."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rivulet.operators.writes import write_mode


class VersionedTable:
    """A table whose every change is a new folder; a row in the version log makes it current.

    Readers see the last logged version, a failed write is never logged, and a
    batch that its writer (a stream's query) has logged is not applied again.
    Two writers may not make the same version: the second one fails.
    """

    _LOG = "version long, writer string, batch long, folder string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(self._LOG).json(f"{self.path}/_versions")
        except AnalysisException:
            return None

    def _last(self):
        log = self._log()
        return None if log is None else log.orderBy(F.desc("version")).limit(1).first()

    def read(self) -> DataFrame | None:
        last = self._last()
        return None if last is None else self.spark.read.parquet(f"{self.path}/{last.folder}")

    def commit(self, df: DataFrame, batch: int | None = None, writer: str = "", after: int | None = None) -> int:
        last = self._last()
        version = 1 if last is None else last.version + 1
        if after is not None and version != after + 1:
            raise RuntimeError(f"version {version - 1} was written meanwhile, the change was made on version {after}")
        folder = f"v{version}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.path}/{folder}")
        row = [(version, writer, batch, folder)]
        self.spark.createDataFrame(row, self._LOG).coalesce(1).write.mode("append").json(f"{self.path}/_versions")
        return version

    def applied(self, batch: int, writer: str = "") -> bool:
        log = self._log()
        return log is not None and log.where((F.col("batch") == batch) & (F.col("writer") == writer)).limit(1).count() > 0

    def apply(self, updates: DataFrame, mode: str, pk: Sequence[str], order: Sequence[str], schema: T.StructType,
              batch: int | None = None, writer: str = "") -> None:
        """Run a write mode against the current version; a batch that this writer has applied is skipped."""
        if batch is not None and self.applied(batch, writer):
            return
        last = self._last()
        current = self.spark.createDataFrame([], schema) if last is None else self.spark.read.parquet(f"{self.path}/{last.folder}")
        self.commit(write_mode(current, updates, mode, pk, order), batch, writer, 0 if last is None else last.version)


class BucketedTable(VersionedTable):
    """A versioned table in buckets of its key: a batch reads and writes only the buckets that its updates touch.

    A version is a manifest: the folders that make up each bucket. Inserts add
    folders to buckets, other modes replace the folders of the touched ones, and
    all other buckets keep theirs. Folders that no kept version names go with
    `expire`. The key, its bucket count and the schema stay as they were first.
    """

    _MANIFEST = "bucket int, folder string"

    def __init__(self, spark: SparkSession, path: str, pk: Sequence[str], schema: T.StructType, buckets: int = 64):
        super().__init__(spark, path)
        self.pk, self.schema, self.buckets = list(pk), schema, buckets

    def _bucket(self):
        return F.pmod(F.xxhash64(*[F.col(c).cast(self.schema[c].dataType).cast("string") for c in self.pk]), F.lit(self.buckets)).cast("int")

    def _parts(self, folder: str) -> list[tuple[int, str]]:
        return [tuple(r) for r in self.spark.read.schema(self._MANIFEST).parquet(f"{self.path}/{folder}").collect()]

    def _rows(self, parts: Sequence[tuple[int, str]]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{folder}/bucket={bucket}" for bucket, folder in sorted(parts)])

    def read(self) -> DataFrame | None:
        last = self._last()
        return None if last is None else self._rows(self._parts(last.folder))

    def apply(self, updates: DataFrame, mode: str, pk: Sequence[str] = (), order: Sequence[str] = ("offset",), schema: T.StructType | None = None,
              batch: int | None = None, writer: str = "") -> None:
        """Run a write mode against the buckets it touches; a batch that this writer has applied is skipped."""
        if pk and list(pk) != self.pk:
            raise ValueError(f"the table's key is {self.pk}")
        if batch is not None and self.applied(batch, writer):
            return
        last = self._last()
        parts = [] if last is None else self._parts(last.folder)
        if mode == "insert":
            kept, made = parts, write_mode(self._rows([]), updates, mode, self.pk, order)
        else:
            # bucket numbers only, as many as there are buckets at most
            touched = {r.b for r in updates.select(self._bucket().alias("b")).distinct().collect()}
            kept = [p for p in parts if p[0] not in touched]
            made = write_mode(self._rows([p for p in parts if p[0] in touched]), updates, mode, self.pk, order)
        folder = f"b{uuid.uuid4().hex}"
        # rebalancing splits a bucket that outgrows a task, and joins small ones
        rows = made.select(*self.schema.names).withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        rows.write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        written = self.spark.read.schema(T.StructType([*self.schema, T.StructField("bucket", T.IntegerType())])).parquet(f"{self.path}/{folder}")
        kept = kept + [(r.bucket, folder) for r in written.select("bucket").distinct().collect()]
        manifest = self.spark.createDataFrame(sorted(kept), self._MANIFEST).coalesce(1)
        self.commit(manifest, batch, writer, 0 if last is None else last.version)

    def expire(self, keep: int = 2) -> list[str]:
        """Delete the folders that only versions before the last `keep` name; returns them. The log keeps all batches.

        Run it while no reader needs the older versions.
        """
        log = self._log()
        versions = [] if log is None else log.orderBy(F.desc("version")).select("folder").collect()
        alive = {row.folder for row in versions[:keep]}
        for row in versions[:keep]:
            alive |= {name for bucket, folder in self._parts(row.folder) for name in (folder, f"{folder}/bucket={bucket}")}
        jvm = self.spark.sparkContext._jvm
        at = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        files = at("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        listed = lambda name: sorted(f.getPath().getName() for f in files.listStatus(at(name)))
        gone = []
        for name in listed(""):
            if name[0] in "bv" and name not in alive:
                gone.append(name)
            elif name[0] == "b":
                gone += [f"{name}/{part}" for part in listed(name) if part.startswith("bucket=") and f"{name}/{part}" not in alive]
        for name in gone:
            files.delete(at(name), True)
        return gone


def load(df: DataFrame, path: str, disposition: str = "append") -> None:
    """Bulk load: `truncate` replaces the table's content, `append` adds to it."""
    modes = {"truncate": "overwrite", "append": "append"}
    if disposition not in modes:
        raise ValueError(f"unknown disposition {disposition!r}")
    df.write.mode(modes[disposition]).parquet(path)


def merge_statement(target: str, staging: str, columns: Sequence[str], pk: Sequence[str], mode: str) -> str:
    """The SQL that moves a staging table into its target."""
    on = " AND ".join(f"t.{c} = s.{c}" for c in pk)
    rest = [c for c in columns if c not in pk]
    names, values = ", ".join(columns), ", ".join(f"s.{c}" for c in columns)
    assign = ", ".join(f"{c} = s.{c}" for c in rest)
    if mode == "insert":
        return f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging}"
    if mode == "delete":
        return f"MERGE INTO {target} t USING {staging} s ON {on} WHEN MATCHED THEN DELETE"
    parts = [f"MERGE INTO {target} t USING {staging} s ON {on}"]
    if mode in ("upsert", "update") and rest:
        parts.append(f"WHEN MATCHED THEN UPDATE SET {assign}")
    if mode in ("upsert", "create"):
        parts.append(f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})")
    return " ".join(parts)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "insert", pk: Sequence[str] = (), batch_size: int = 10_000,
               retries: int = 3, backoff: float = 0.5, **options) -> None:
    """Write to a database table.

    `insert` appends in batches. The other modes load a staging table in
    parallel and move it into the target by one statement in one transaction,
    so a retried task never leaves half a batch behind.
    """
    if mode == "insert":
        df.write.format("jdbc").options(url=url, dbtable=table, batchsize=batch_size, **options).mode("append").save()
        return
    missing = [k for k in pk if k not in df.columns]
    if not pk or missing:
        raise ValueError(f"mode {mode!r} needs the key columns {missing or 'named'}")
    staging = f"{table}_stage_{uuid.uuid4().hex[:8]}"
    df.write.format("jdbc").options(url=url, dbtable=staging, batchsize=batch_size, **options).mode("overwrite").save()
    statement = merge_statement(table, staging, df.columns, pk, mode)
    manager = df.sparkSession.sparkContext._jvm.java.sql.DriverManager
    for attempt in range(retries + 1):
        connection = manager.getConnection(url)
        try:
            connection.setAutoCommit(False)
            connection.createStatement().executeUpdate(statement)
            connection.createStatement().executeUpdate(f"DROP TABLE {staging}")
            connection.commit()
            return
        except Exception:
            connection.rollback()
            if attempt == retries:
                raise
            time.sleep(backoff * 2**attempt)
        finally:
            connection.close()
