"""Session settings and the checkpoint location."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Operators with list state and timers need this store.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

DEFAULTS = {
    **STATE_STORE,
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "rivulet", **conf) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; a scratch one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rivulet-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several later steps read."""
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
