"""Session helpers: defaults for local runs and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

STREAM_DEFAULTS = {
    # State that outgrows executor memory lives in RocksDB; changelog checkpoints upload only deltas.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Merge the sessions of each input partition before the shuffle, so that one busy key sends a
    # few merged sessions instead of all its rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Persisted rows that do not fit into memory go to disk through an object stream, which holds on to a hundred batches of them at a
    # time, writing and reading. Messages are a kilobyte each, so batches of 10,000 rows would take a gigabyte a task.
    "spark.sql.inMemoryColumnarStorage.batchSize": "500",
}


def local_session(
    cores: str = "*", partitions: int = 8, memory: str = "8g", conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("clickloom")
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(partitions)))
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results depend on: epoch milliseconds are read and printed as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def prepare_streaming(spark: SparkSession) -> SparkSession:
    prepare(spark)
    for key, value in STREAM_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; local runs without one get a temporary folder."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    path = tempfile.mkdtemp(prefix="clickloom-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return os.path.join(shared_dir(spark), f"clickloom-{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written below the shared folder and read again: worked out once, however often and in whatever columns they are read."""
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
