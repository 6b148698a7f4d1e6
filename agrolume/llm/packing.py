"""Bounded-space online packing of token ids into sequences of a fixed length.

Every partition keeps a fixed number of open windows. A document fills whole
sequences first; what remains goes to the open window it fits best. When it fits
none, the fullest window is topped up with the head of the piece, if the room is
worth a cut, and emitted. What stays open at the end of the partitions is merged,
some dozens of partitions at a time.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.llm import tokens
from agrolume.llm.common import table, texts, written

LENGTH = 2048
#: Open windows a partition keeps.
OPEN = 32
#: Room that is worth a cut when a window is emitted; less is padded.
WORTH = 8
#: Partitions whose open windows are merged together: OPEN * TOGETHER windows of ids at most.
TOGETHER = 16
#: The id that ends a document.
END = 1
PIECES = "doc_id bigint, start bigint, ids array<int>, doc_tokens bigint, sequence_id bigint, offset bigint, length bigint, ids_crc32 bigint"


class Windows:
    """Open windows ordered by their room. A window is [its number, fill, pieces]."""

    def __init__(self, length: int, most: int, worth: int):
        self.length, self.most, self.worth = length, most, worth
        self.room: list[int] = []
        self.open: list[list] = []
        self.count = 0

    def _put(self, window: list) -> None:
        k = bisect.bisect_left(self.room, room := self.length - window[1])
        self.room.insert(k, room)
        self.open.insert(k, window)

    def _new(self, pieces: list) -> list:
        self.count += 1
        return [self.count - 1, sum(len(p[2]) for p in pieces), pieces]

    def add(self, doc: int | None, start: int, ids: np.ndarray, total: int) -> Iterator[list]:
        """Places a piece; yields the windows that it closes."""
        while len(ids) >= self.length:
            yield self._new([(doc, start, ids[: self.length], total)])
            start, ids = start + self.length, ids[self.length :]
        if not len(ids):
            return
        k = bisect.bisect_left(self.room, len(ids))  # the least room that holds it
        if k == len(self.room):
            if len(self.open) == self.most:
                room, fullest = self.room.pop(0), self.open.pop(0)
                if self.worth <= room < len(ids):
                    fullest[2].append((doc, start, ids[:room], total))
                    start, ids = start + room, ids[room:]
                yield fullest
            k = bisect.bisect_left(self.room, len(ids))
        if k < len(self.room):
            self.room.pop(k)
            window = self.open.pop(k)
            window[2].append((doc, start, ids, total))
            window[1] += len(ids)
        else:
            window = self._new([(doc, start, ids, total)])
        if window[1] == self.length:
            yield window
        else:
            self._put(window)


def _rows(windows: list[list], base: int, closed: bool) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in ("doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset", "length", "ids_crc32", "closed")}
    for number, _, pieces in windows:
        at = 0
        for doc, start, ids, total in pieces:
            for k, v in zip(out, (doc, start, ids, total, base + number, at, len(ids), zlib.crc32(ids.astype("<u4")), closed), strict=True):
                out[k].append(v)
            at += len(ids)
    return out


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32())), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("closed", pa.bool_()), ("part", pa.int64())])


def _batch(windows: list[list], base: int, closed: bool, part: int) -> pa.RecordBatch:
    rows = _rows(windows, base, closed)
    sizes = np.fromiter(map(len, rows["ids"]), np.int32, len(rows["ids"]))
    flat = np.concatenate(rows["ids"]).astype(np.int32) if rows["ids"] else np.empty(0, np.int32)
    ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(flat))
    columns = [ids if k == "ids" else pa.array(v, _SCHEMA.field(k).type) for k, v in rows.items()]
    return pa.RecordBatch.from_arrays([*columns, pa.array([part] * len(sizes), pa.int64())], schema=_SCHEMA)


def pack(docs: DataFrame, path: str | None = None, *, length: int = LENGTH, open_windows: int = OPEN, worth: int = WORTH, together: int = TOGETHER, end: int = END) -> DataFrame:
    """Pack all documents; returns PIECES, one row per piece, ids included.

    Reads doc_id and text of ``docs``; other columns are ignored. A null or empty text is the end id alone.
    Repeated rows are packed each, a null doc_id stays null, no rows give no pieces. ``start`` counts the
    document's ids before the piece, ``offset`` the sequence's; ``ids_crc32`` is that of the ids as unsigned little-endian
    32-bit integers. A long text is held by one task at a time.
    A sequence id is its partition's number and a count, so a rerun task repeats its ids.
    """
    path = path or tokens.vocabulary()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path).encode
        part = TaskContext.get().partitionId()
        base, windows, done, held = part << 32, Windows(length, open_windows, worth), [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(encode(text.as_py()) + end.to_bytes(2, "little"), "<u2")
                for window in windows.add(doc, 0, ids, len(ids)):
                    done.append(window)
                    held += length
                if held >= 500_000:
                    yield _batch(done, base, True, part)
                    done, held = [], 0
        if done:
            yield _batch(done, base, True, part)
        if windows.open:
            yield _batch(windows.open, base, False, part)

    placed = written(texts(docs).mapInArrow(place, f"{PIECES}, closed boolean, part bigint"), "packing")
    columns = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset", "length", "ids_crc32"]

    def merge(key: tuple, rest: pd.DataFrame) -> pd.DataFrame:
        # Cut wherever a sequence is full: one sequence of the group at most is not.
        rest = rest.sort_values(["sequence_id", "offset"])
        windows, done = Windows(length, 1, 1), []
        for doc, start, ids, total in zip(rest.doc_id, rest.start, rest.ids, rest.doc_tokens, strict=True):
            done.extend(windows.add(None if pd.isna(doc) else int(doc), int(start), np.asarray(ids), int(total)))
        rows = _rows(done + windows.open, (1 << 62) + (int(key[0]) << 32), True)
        del rows["closed"]
        return pd.DataFrame(rows).assign(doc_id=lambda x: x.doc_id.astype("Int64"))

    rest = placed.where(~F.col("closed")).groupBy((F.col("part") / together).cast("bigint").alias("group")).applyInPandas(merge, PIECES)
    return placed.where("closed").select(columns).unionByName(rest)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids, one row per piece."""
    return pack(table(spark, sf_dir, "documents")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
