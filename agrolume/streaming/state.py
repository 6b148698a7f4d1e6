"""Keyed state with timers and expiry.

The processors are defined inside functions so that they reach the executors by
value. Before the shuffle each Arrow batch is reduced to the newest row per key,
so a key with very many events does not flood one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State with timers and expiry needs the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def newest_per_key(stream: DataFrame, *, key: str, by: list[str]) -> DataFrame:
    """Keep only the row per key of each Arrow batch that is last by some columns."""

    def reduce(batches: Iterator[Any]) -> Iterator[Any]:
        for pdf in batches:
            yield pdf.sort_values([key, *by]).drop_duplicates(key, keep="last")

    return stream.mapInPandas(reduce, stream.schema)


def heartbeat_timeouts(stream: DataFrame, *, key: str, time: str, timeout_ms: int, delay: str) -> DataFrame:
    """(key, last heartbeat) of every worker that stayed silent for the timeout.

    Event time: the timer of a key is moved on each heartbeat and fires once the
    watermark has passed it.
    """
    import pandas as pd

    name = key

    class Watch(StatefulProcessor):
        def init(self, handle: Any) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", StructType().add("at_ms", "long"))

        def handleInputRows(self, key: Any, rows: Iterator[Any], timerValues: Any) -> Iterator[Any]:
            newest = max(int(pdf["at_ms"].max()) for pdf in rows)
            if self.last.exists():
                newest = max(newest, int(self.last.get()[0]))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.last.update((newest,))
            self.handle.registerTimer(newest + timeout_ms)
            yield pd.DataFrame({name: pd.Series(dtype="int64"), "last_ms": pd.Series(dtype="int64")})

        def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Any]:
            last = int(self.last.get()[0])
            self.last.clear()
            yield pd.DataFrame({name: [int(key[0])], "last_ms": [last]})

        def close(self) -> None:
            pass

    use_rocksdb(stream.sparkSession)
    marked = newest_per_key(stream.selectExpr(key, time, f"unix_millis({time}) as at_ms"), key=key, by=[time])
    watched = marked.withWatermark(time, delay).groupBy(key)
    schema = StructType().add(key, "long").add("last_ms", "long")
    return watched.transformWithStateInPandas(
        statefulProcessor=Watch(), outputStructType=schema, outputMode="append", timeMode="EventTime"
    )


def ttl_cache(stream: DataFrame, *, key: str, time: str, value: str, ttl_ms: int, delay_ms: int) -> DataFrame:
    """(key, at_ms, value) at each update of a key, and value NULL once its newest one is ``ttl_ms`` old.

    Event time, so a replay gives the same rows. The clock of the cache is ``delay_ms`` behind the newest event. The watermark
    runs a further ``ttl_ms`` behind and a timer stands at the time of the newest value: it passes
    when the value expires, and a row that comes too late for it is one that has expired already. Of values of one time the largest counts.
    """
    import pandas as pd

    name = key

    def row(key: Any, at_ms: int, held: float | None) -> Any:
        return pd.DataFrame({name: [int(key[0])], "at_ms": [at_ms], "value": pd.Series([held], dtype="float64")})

    class Cache(StatefulProcessor):
        def init(self, handle: Any) -> None:
            self.handle = handle
            self.entry = handle.getValueState("entry", StructType().add("at_ms", "long").add("value", "double"))

        def handleInputRows(self, key: Any, rows: Iterator[Any], timerValues: Any) -> Iterator[Any]:
            found = [(int(a), float(v)) for pdf in rows for a, v in zip(pdf["at_ms"], pdf[value], strict=True)]
            if self.entry.exists():
                held = self.entry.get()
                found.append((int(held[0]), float(held[1])))
            best = max(found)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.entry.update(best)
            self.handle.registerTimer(best[0])
            yield row(key, *best)

        def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Any]:
            at_ms = int(self.entry.get()[0])
            self.entry.clear()
            yield row(key, at_ms, None)

        def close(self) -> None:
            pass

    use_rocksdb(stream.sparkSession)
    rows = stream.where(f"{time} is not null and {value} is not null")
    marked = newest_per_key(rows.selectExpr(key, time, value, f"unix_millis({time}) as at_ms"), key=key, by=["at_ms", value])
    schema = StructType().add(key, "long").add("at_ms", "long").add("value", "double")
    watched = marked.withWatermark(time, f"{delay_ms + ttl_ms} milliseconds").groupBy(key)
    return watched.transformWithStateInPandas(
        statefulProcessor=Cache(), outputStructType=schema, outputMode="append", timeMode="EventTime"
    )


def still_held(emitted: DataFrame, key: str) -> DataFrame:
    """What a cache holds in the end: the last row of each key, unless it is an expiry.

    ``emitted`` has the rows of ttl_cache with their batch_id; a key updated and expired in one batch has expired, as timers come last.
    """
    last = F.max(F.struct("batch_id", F.col("value").isNull().alias("gone"), "at_ms", "value")).alias("last")
    return emitted.groupBy(key).agg(last).where("not last.gone").select(key, "last.at_ms", "last.value")
