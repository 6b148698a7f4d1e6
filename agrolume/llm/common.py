"""Helpers that the corpus operators share: tables, the shared folder, written steps."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path that the driver and every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session, where driver
    and executors are one process, may go without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-corpus-")
    return f"{base.rstrip('/')}/{label}-{uuid4().hex}"


#: Shuffle files of a written step go when it is written; Spark keeps them until the driver collects its garbage otherwise.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows behind a table in the shared folder: computed once, lineage cut."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        # Bound to the session's settings as they are when it is planned.
        df.select("*").write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that tasks can import it."""
    if spark.sparkContext.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="spark-package-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        _shipped.add(spark.sparkContext.applicationId)


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text only, a null text as the empty one: other columns never get in the way."""
    ship(docs.sparkSession)
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def is_true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))
