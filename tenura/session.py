"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Skewed joins are split even when the split costs one more shuffle: an account may
# hold a large part of all rows.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Keyed state of a stream lies on the executors' disks (RocksDB), with this much in their memory however large it
# grows; a partition's store is closed once its task has committed.  Nothing reads the number of its rows.
_STATE = "spark.sql.streaming.stateStore"
STATE_SETTINGS = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.unloadOnCommit": "true",
    f"{_STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STATE}.rocksdb.maxMemoryUsageMB": "128",
    f"{_STATE}.rocksdb.writeBufferSizeMB": "16",
    f"{_STATE}.rocksdb.maxWriteBufferNumber": "2",
    f"{_STATE}.rocksdb.trackTotalNumberOfRows": "false",
}
# On one machine, small shuffles should still use all cores.  On a cluster the default
# keeps them to few tasks.
LOCAL_SETTINGS = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the operators rely on; all can be set at run time."""
    local = spark.sparkContext.master.startswith("local")
    for name, value in (SQL_SETTINGS | STATE_SETTINGS | (LOCAL_SETTINGS if local else {})).items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tenura")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by spark.checkpoint.dir.

    Only a local master may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="tenura-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; never used twice."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder once and go on from the written table.

    Used where several steps must see exactly the same rows, also after an executor is
    lost, and where computing them twice would cost more than a write.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
