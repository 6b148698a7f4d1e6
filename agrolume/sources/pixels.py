"""Reading and writing pixel tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.operators import raster

#: Files that a task writes side by side.
WRITERS = 64
Range = tuple[int | None, int | None]


def _within(column: str, bounds: Range) -> Column:
    low, high = bounds
    test = F.lit(True)
    if low is not None:
        test = test & (F.col(column) >= low)
    if high is not None:
        test = test & (F.col(column) <= high)
    return test


def scan_window(
    pixels: DataFrame,
    *,
    source_no: int | None = None,
    ym: Range = (None, None),
    rows: Range = (None, None),
    cols: Range = (None, None),
    columns: list[str] | None = None,
) -> DataFrame:
    """Pixels of one source, month range and row/column window.

    Plain filters and a projection: on a table written by ``write_pixels`` the
    source and month prune partitions, the row and column ranges prune Parquet
    row groups, and only the asked columns are read.
    """
    out = pixels
    if source_no is not None:
        out = out.where(F.col("source_no") == source_no)
    out = out.where(_within("ym", ym) & _within("rw", rows) & _within("cl", cols))
    return out.select(*columns) if columns else out


def write_pixels(pixels: DataFrame, path: str, *, tile: int = 512) -> None:
    """Write pixels by source and month, clustered by tile inside each file.

    The range partitioning key ends with the tile and the position, so one hot
    source or month spreads over many tasks and files.
    """
    tiled = pixels.withColumn("tile_r", F.floor(F.col("rw") / tile)).withColumn(
        "tile_c", F.floor(F.col("cl") / tile)
    )
    order = ["source_no", "ym", "tile_r", "tile_c", "rw", "cl"]
    (
        tiled.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy("source_no", "ym")
        .parquet(path)
    )


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_index_partitions(pixels: DataFrame, path: str) -> None:
    """Derived index sink: partitioned by source, index and acquisition month, clustered by scene inside each file.

    The raw pixels are ranged and sorted, once each, before they become codes and a row per index:
    finding the ranges takes no codes, and the rows of an index keep the order of their pixels. A task holds few months,
    so it keeps a file per index and month open instead of sorting again; beyond WRITERS files it sorts the rest.
    """
    order = ["source_no", "ym", "scene_id", "rw", "cl"]
    near = pixels.repartitionByRange(*order).sortWithinPartitions(*order)
    conf, name = pixels.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, WRITERS)
    try:
        raster.by_index(raster.coded(near)).write.mode("overwrite").partitionBy("source_no", "index_name", "ym").parquet(path)
    finally:
        conf.set(name, before)


def derived_path(provider: Column, source_id: Column, item_id: Column, index_name: Column) -> Column:
    """Deterministic object path of one derived index raster."""
    return F.concat_ws(
        "/", F.lit("derived"), provider, source_id, item_id, F.concat(index_name, F.lit(".parquet"))
    )


def write_stream_files(pixels: DataFrame, path: str) -> None:
    """Write pixels as plain files, clustered by scene, for a file stream to read."""
    pixels.repartitionByRange("scene_id", "rw", "cl").write.mode("overwrite").parquet(path)
