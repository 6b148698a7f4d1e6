"""Benchmark decontamination by q-gram filtering and banded alignment.

Texts are compared by their letters and digits alone, in lower case. A passage of m
characters that occurs with at most k edits shares m + 1 - q - k * q character q-grams
with its place (q-gram lemma), and all of them lie on diagonals within k of each other.
Diagonals are cut into bands that overlap by half, so one band holds them all; bands
that reach the bound are verified by aligning the passage within the band.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.llm import hashing
from agrolume.llm.common import ship, table, texts, written

Q = 10
#: Share of a passage's characters that may be edited.
EDITS = 0.08
#: A passage with fewer letters and digits is found only unedited, from the start of a word to the end of one.
LEAST = 24
#: Characters of passages that one broadcast index holds; more passages are searched in several passes.
INDEX_CHARS = 1_500_000

_lower: list[np.ndarray] = []


def _table() -> np.ndarray:
    """Lower-case form of the characters below U+10000 that are letters or digits, 0 for the others."""
    if not _lower:
        out = np.zeros(0x10000, np.uint32)
        for i in range(0x10000):
            c = chr(i)
            if c.isalnum():
                low = c.lower()
                out[i] = ord(low) if len(low) == 1 else i
        _lower.append(out)
    return _lower[0]


def plain(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(letters and digits in lower case, their places in the text)."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    low = np.where(points < 0x10000, _table()[np.minimum(points, 0xFFFF)], 0)
    for c in np.unique(points[points >= 0x10000]).tolist():
        if chr(c).isalnum():
            low[points == c] = ord(chr(c).lower()[0])
    at = np.flatnonzero(low)
    return low[at], at


def grams(chars: np.ndarray, q: int) -> np.ndarray:
    """Hash of every q-gram."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    wide = chars.astype(np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(q):
        out = out * np.uint64(0x9E3779B97F4A7C15) + wide[j : n + j]
    return hashing.mix(out)


def words_at(doc: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the stretches of n characters that begin with a word and end with one."""
    gap = np.diff(at) > 1
    first, last = np.append(True, gap), np.append(gap, True)
    starts = np.flatnonzero(first[: max(0, len(doc) - n + 1)])
    starts = starts[last[starts + n - 1]]
    out = np.zeros(len(starts), np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + doc[starts + j].astype(np.uint64)
    return starts, out


def align(item: np.ndarray, doc: np.ndarray, slack: int, anchored: bool = False) -> tuple[int, int]:
    """(fewest edits from the item to a part of doc, where that part ends), right up to ``slack`` edits.

    The part may begin anywhere, or at 0 if anchored. Row by row over the item; a cell is a
    diagonal, so the whole band is one vector. ``slack`` diagonals lie beyond either end of doc.
    """
    m, width = len(item), max(1, len(doc) - len(item) + 1) + 2 * slack
    pad = np.concatenate((np.zeros(slack, doc.dtype), doc, np.zeros(m + width, doc.dtype)))  # 0 is no character
    steps = np.arange(width)
    cost = np.where(steps < slack, m + width, steps - slack) if anchored else np.zeros(width, np.int64)
    for i in range(m):
        through = cost + (pad[i : i + width] != item[i])
        skipped = np.append(cost[1:], m + width) + 1
        cost = np.minimum(through, skipped)
        cost = np.minimum.accumulate(cost - steps) + steps
    best = int(np.argmin(cost))
    return int(cost[best]), min(max(m + best - slack, 0), len(doc))


@dataclass(frozen=True)
class Index:
    """q-grams of the passages, sorted by hash, with the passage and place of each."""

    q: int
    ids: np.ndarray
    chars: list[np.ndarray]
    budget: np.ndarray
    need: np.ndarray
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    maybe: np.ndarray
    #: Short passages: per number of characters, hash -> (id, characters) of each.
    short: dict[int, dict[int, list[tuple[int, np.ndarray]]]]

    @staticmethod
    def of(passages: list[tuple[int, str]], q: int, edits: float, least: int) -> Index | None:
        known = [(i, c) for i, t in passages if len(c := plain(t)[0])]
        held = [(i, c) for i, c in known if len(c) >= max(least, q + 1)]
        if not known:
            return None
        short: dict[int, dict[int, list[tuple[int, np.ndarray]]]] = {}
        for i, c in known:
            if len(c) < max(least, q + 1):
                key = int(words_at(c, np.arange(len(c)), len(c))[1][0])
                short.setdefault(len(c), {}).setdefault(key, []).append((i, c))
        sizes = np.array([len(c) for _, c in held], np.int64)
        # A budget so large that no shared q-gram is certain is lowered until one is.
        budget = np.minimum(np.floor(edits * sizes), (sizes - q) // q).astype(np.int64)
        all_grams = [grams(c, q) for _, c in held]
        hashes = np.concatenate([np.empty(0, np.uint64), *all_grams])
        order = np.argsort(hashes, kind="stable")
        item = np.repeat(np.arange(len(held)), np.array([len(g) for g in all_grams], np.int64))
        place = np.concatenate([np.empty(0, np.int64), *[np.arange(len(g)) for g in all_grams]])
        maybe = np.zeros(1 << 22, bool)
        maybe[hashes >> np.uint64(42)] = True
        return Index(q, np.array([i for i, _ in held]), [c for _, c in held], budget, sizes + 1 - q - budget * q, hashes[order], item[order], place[order], maybe, short)

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(passage id, start, end, edits) of every passage found; start and end count code points of the text."""
        doc, at = plain(text)
        return sorted(self._near(doc, at) + self._exact(doc, at))

    def _exact(self, doc: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        out = []
        for n, held in self.short.items():
            if n > len(doc):
                continue
            starts, hashes = words_at(doc, at, n)
            for k in np.flatnonzero(np.isin(hashes, np.array(list(held), np.uint64))).tolist():
                start = int(starts[k])
                out += [(i, int(at[start]), int(at[start + n - 1]) + 1, 0) for i, c in held[int(hashes[k])] if np.array_equal(c, doc[start : start + n])]
        return out

    def _near(self, doc: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        found = grams(doc, self.q)
        spots = np.flatnonzero(self.maybe[found >> np.uint64(42)])
        lo, hi = np.searchsorted(self.hashes, found[spots], "left"), np.searchsorted(self.hashes, found[spots], "right")
        count = hi - lo
        if not count.sum():
            return []
        which = np.repeat(lo - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        item = self.item[which]
        diagonal = np.repeat(spots, count) - self.place[which]
        half = self.budget[item] + 1
        band = diagonal // half
        # Each shared q-gram counts in the two bands that overlap on its diagonal.
        keys = np.stack((np.concatenate((item, item)), np.concatenate((band, band - 1))), 1)
        keys, votes = np.unique(keys, axis=0, return_counts=True)
        out = []
        for k, b in keys[votes >= self.need[keys[:, 0]]].tolist():
            chars, half, budget = self.chars[k], int(self.budget[k]) + 1, int(self.budget[k])
            first = max(0, b * half - budget)
            region = doc[first : max(0, (b + 2) * half) + len(chars) + budget]
            edits, end = align(chars, region, budget)
            if edits <= budget:
                size = align(chars[::-1], region[:end][::-1], budget, anchored=True)[1]
                out.append((edits, first + end - size, first + end, k))
        out.sort()
        kept: list[tuple[int, int, int, int]] = []
        for edits, start, end, k in out:  # of places of a passage that overlap, the best
            if not any(k == o[3] and start < o[2] and o[1] < end for o in kept):
                kept.append((edits, start, end, k))
        return [(int(self.ids[k]), int(at[start]), int(at[end - 1]) + 1, edits) for edits, start, end, k in kept]


def indexes(benchmark: DataFrame, q: int = Q, edits: float = EDITS, least: int = LEAST, chars: int = INDEX_CHARS) -> Iterator[tuple[Index, bool]]:
    """(index, whether it is the only one): of bounded size, together they hold all passages with an id and a letter or digit."""
    known = benchmark.select("item_id", "text").where("item_id is not null and text is not null")
    total = known.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, math.ceil(total / chars))
    for k in range(shards):
        rows = known.where(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == k).collect()
        if index := Index.of([(r.item_id, r.text) for r in rows], q, edits, least):
            yield index, shards == 1


def leaks(docs: DataFrame, benchmark: DataFrame, *, q: int = Q, edits: float = EDITS, least: int = LEAST, index_chars: int = INDEX_CHARS) -> DataFrame:
    """(doc_id, item_id, start, end, edits): every place of a document that holds a passage.

    A passage of fewer than ``least`` letters and digits counts where it stands unedited between word bounds. A null or
    empty text holds none, repeated rows give their places each, a null doc_id stays null. Other columns are
    ignored. Texts of any length are searched whole. Documents are read once per index; an index larger than the bound
    is never made, and of several ones each is gone, and what it found written, before the next is sent.
    """
    spark = docs.sparkSession
    rows = texts(docs)
    schema = "doc_id bigint, item_id bigint, start bigint, end bigint, edits bigint"
    out = spark.createDataFrame([], schema)
    for index, alone in indexes(benchmark, q, edits, least, index_chars):
        sent = spark.sparkContext.broadcast(index)

        def find(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places = [(doc, *p) for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True) for p in sent.value.find(text.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in places], pa.int64()) for i in range(5)], names=["doc_id", "item_id", "start", "end", "edits"])

        found = rows.mapInArrow(find, schema)
        if alone:
            return found
        out = out.unionByName(written(found, "leaks"))
        sent.destroy()
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, q: int = Q, edits: float = EDITS, least: int = LEAST, index_chars: int = INDEX_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no passage as in ``leaks``; a null text holds none. Nothing is shuffled."""
    spark = docs.sparkSession
    ship(spark)
    for index, alone in indexes(benchmark, q, edits, least, index_chars):
        sent = spark.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not sent.value.find(t.as_py() or "") for t in batch.column("text")], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
        if not alone:
            docs = written(docs, "without-leaks")
            sent.destroy()
    return docs


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of a document that holds a benchmark passage."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
