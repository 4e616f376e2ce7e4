"""Session settings the operators are written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lathework")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="lathework-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_scratch: list[str] = []


def scratch_folder(spark: SparkSession) -> str:
    """A fresh path below the shared folder; ``drop_scratch`` removes it."""
    folder = f"{shared_folder(spark).rstrip('/')}/lathework-{uuid.uuid4().hex}"
    _scratch.append(folder)
    return folder


def drop_scratch(spark: SparkSession) -> None:
    """Removes the tables that operators have written below the shared folder, once their results are no longer needed.

    DataFrames that read them cannot be evaluated afterwards. Checkpoints are Spark's own and
    go with ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(hadoop).delete(path, True)


def ensure_checkpoint_folder(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
