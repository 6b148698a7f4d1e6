"""Session settings that suit the operators in this package."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What a join broadcasts is decided by the sizes of its finished stages. Estimates
    # from file sizes know nothing of generators (days, spans, pixels of a block) and would send tables
    # that grow with the data through the driver; below this size they may be trusted.
    "spark.sql.autoBroadcastJoinThreshold": "64k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "8m",
    # Shuffles start out fine and are merged by measured size, so a task's rows do not grow with the table.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # A scan's rows are sorted and grouped by the task that reads them: files are cut as fine, not by bytes per core.
    "spark.sql.files.maxPartitionBytes": "16m",
    # Persisted results are merged too.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    # Pixel work per byte is high: keep all cores busy on small shuffles too.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # The JVM never compiles methods above 8000 bytes of bytecode; beyond that
    # Spark's operator-by-operator path is about three times faster here.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Exact percentiles keep one value->count map per group; stay hash-based a
    # little longer before falling back to the (spilling) sort-based path.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def local_session(
    cores: int | str = 8,
    *,
    app_name: str = "agrolume",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
) -> SparkSession:
    """Build a local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session, where driver and
    executors are one process, may go without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{label}-{uuid4().hex}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"spark-{label}-")


def shared(df: DataFrame) -> DataFrame:
    """The same rows, computed once when they are first read, for results that several steps of one query read.

    Nothing runs while a query is built. Blocks that are lost with an executor
    are computed again from their lineage; ``spark.catalog.clearCache()`` lets go of them.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows behind a written table: computed once, lineage cut.

    For results that several later steps read. The table lives in the shared
    folder, so it outlives a lost executor.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
