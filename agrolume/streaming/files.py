"""Finite file streams, an idempotent per-batch store and a compacted keyed store."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from agrolume.session import shared_folder


def read_files(
    spark: SparkSession, folder: str, schema: StructType, *, only: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Stream the Parquet files of a folder, optionally only those matching a glob."""
    reader = spark.readStream.schema(schema)
    if only is not None:
        reader = reader.option("pathGlobFilter", only)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


class BatchStore:
    """One folder per micro-batch, replaced whole when a batch is run again.

    Because a batch always lands in the folder of its own id, a replay after an
    executor or driver loss overwrites instead of adding, and reading the store
    sees every batch exactly once.
    """

    def __init__(self, spark: SparkSession, label: str, path: str | None = None):
        self.spark = spark
        self.path = path or shared_folder(spark, label)

    def save(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={batch_id}")

    def read(self, schema: StructType) -> DataFrame:
        """All batches with their ``batch_id``."""
        return self.spark.read.schema(schema.add("batch_id", "long") if "batch_id" not in schema.names else schema).parquet(
            f"{self.path}/batches"
        )


class KeyedStore:
    """The current row of every key, kept up to date batch by batch in few runs of growing size.

    A batch is folded to one row per key and written as a run of level 0; FAN runs of one level are folded into one of the
    next. So a row is written again once per level, not once per batch, and a read opens fewer than FAN runs per level:
    their number grows with the logarithm of the batches.

    A manifest per batch names the valid runs. The batch counts once its manifest is renamed into place: one that
    dies before leaves the former manifest valid, and one that comes again after changes nothing. Runs that
    neither of the two newest manifests names are deleted.

    ``fold`` takes rows of ``schema`` and returns one row per key; folding folded rows again must give what folding all
    of them at once does.
    """

    FAN = 8

    def __init__(
        self, spark: SparkSession, label: str, *, schema: StructType, fold: Callable[[DataFrame], DataFrame], path: str | None = None, fan: int = FAN
    ):
        self.spark, self.schema, self.fold, self.fan = spark, schema, fold, fan
        self.path = path or shared_folder(spark, label)

    def _files(self) -> tuple[Any, Callable[[str], Any]]:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        at = lambda name: hadoop.Path(f"{self.path}/{name}")
        return hadoop.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def batches(self) -> list[int]:
        """Ids of the batches whose manifests are kept, newest last."""
        fs, at = self._files()
        if not fs.exists(at("manifests")):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(at("manifests"))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, batch_id: int | None = None) -> list[tuple[int, str]]:
        """(level, folder) of every valid run, of the newest batch unless another one is named."""
        kept = self.batches()
        if not kept:
            return []
        name = f"{self.path}/manifests/{kept[-1] if batch_id is None else batch_id}.json"
        return [(level, folder) for level, folder in json.loads(self.spark.read.text(name, wholetext=True).first()[0])]

    def _rows(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/runs/{f}" for f in folders])

    def read(self, *, placed: bool = False) -> DataFrame:
        """The current rows; ``placed`` folds a single run too, for steps that want rows where the fold puts them."""
        folders = [folder for _, folder in self.manifest()]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self._rows(folders) if len(folders) == 1 and not placed else self.fold(self._rows(folders))

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Take the rows of a batch in; one that is in already is left alone."""
        kept = self.batches()
        if kept and batch_id <= kept[-1]:
            return
        new = f"{batch_id}-{uuid4().hex}"
        self.fold(batch).write.parquet(f"{self.path}/runs/{new}")
        runs = [*self.manifest(), (0, new)]
        level = 0
        # The new run may fill several levels at once; they are folded together.
        while sum(at == level for at, _ in runs) + (level > 0) >= self.fan:
            level += 1
        if level:
            old = [folder for at, folder in runs if at < level]
            self.fold(self._rows(old)).write.parquet(f"{self.path}/runs/{new}-{level}")
            runs = [*[run for run in runs if run[0] >= level], (level, f"{new}-{level}")]
        self.commit(runs, batch_id)

    def commit(self, runs: list[tuple[int, str]], batch_id: int) -> None:
        """Put a manifest in place and drop what the two newest ones do not name."""
        fs, at = self._files()
        fs.mkdirs(at("manifests"))
        draft = at(f"manifests/.{batch_id}-{uuid4().hex}")
        out = fs.create(draft, True)
        out.write(json.dumps(runs).encode())
        out.close()
        if not fs.rename(draft, at(f"manifests/{batch_id}.json")):
            raise RuntimeError(f"batch {batch_id} has a manifest already")
        kept = self.batches()
        named = {folder for k in kept[-2:] for _, folder in self.manifest(k)}
        for old in kept[:-2]:
            fs.delete(at(f"manifests/{old}.json"), False)
        for status in fs.listStatus(at("runs")):
            if status.getPath().getName() not in named:
                fs.delete(status.getPath(), True)


def run_to_end(
    stream: DataFrame, *, mode: str, each_batch: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False
) -> None:
    """Process everything that is available, then stop.

    ``once`` takes it as a single batch. State with processing-time expiry needs
    that: its clock alone always asks for another batch, so it would never stop.
    """
    trigger = {"once": True} if once else {"availableNow": True}
    running = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(each_batch)
        .start()
    )
    running.awaitTermination()


def collect_batches(stream: DataFrame, *, mode: str, label: str, once: bool = False) -> DataFrame:
    """Run a finite stream and return every emitted row with its batch id."""
    store = BatchStore(stream.sparkSession, label)
    run_to_end(stream, mode=mode, each_batch=store.save, checkpoint=f"{store.path}/checkpoint", once=once)
    return store.read(StructType(stream.schema.fields))
