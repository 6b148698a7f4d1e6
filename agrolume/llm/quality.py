"""Quality classifier: random Fourier features over document statistics, ridge, isotonic calibration.

A Gaussian kernel over standardised statistics is approximated by cosines of random
projections. Every partition sums its part of the normal equations; the sums are added up
by row and solved on the driver, whose size depends on the number of features alone. Scores
of rows that a fit has not seen give the calibration.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.llm import hashing
from agrolume.llm.common import table, texts, written

NAMES = (
    "chars", "words", "word_length", "distinct_words", "top_word", "same_as_before", "distinct_pairs", "lines", "line_length", "distinct_lines",
    "upper", "digits", "blanks", "marks", "stops", "bars", "rare_marks", "marks_after_words", "longest_word", "packed",
)
#: Cosines; with the statistics themselves and a constant they are the columns of the fit.
COSINES = 256
FOLDS = 4
BINS = 1000
RIDGE = 1e-3

_BYTE = np.zeros((6, 256), bool)
_BYTE[0, 65:91] = True
_BYTE[1, 48:58] = True
_BYTE[2, [9, 10, 11, 12, 13, 32]] = True
_BYTE[3, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_BYTE[4, [33, 44, 46, 63]] = True
_BYTE[5, [35, 36, 37, 38, 42, 64, 94, 126, 124, 33]] = True


def statistics(text: bytes, words: np.ndarray) -> list[float]:
    """NAMES of one text from its UTF-8 bytes and word hashes; those of an empty text are 0."""
    if not text:
        return [0.0] * len(NAMES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    upper, digits, blanks, marks, stops, rare = (counts @ _BYTE.T).tolist()
    lines = text.split(b"\n")
    k = max(1, len(words))
    distinct, times = np.unique(words, return_counts=True) if len(words) else (words, np.zeros(1))
    pairs = hashing.shingles(words, 2)
    split = text.split()
    after = sum(w[-1] in b"!#$%&*|" for w in split)
    return [
        np.log1p(n), np.log1p(len(words)), n / k, len(distinct) / k, float(times.max()) / k,
        float((words[1:] == words[:-1]).sum()) / k, len(np.unique(pairs)) / max(1, len(pairs)),
        np.log1p(len(lines)), np.log1p(n / len(lines)), len(set(lines)) / len(lines),
        upper / n, digits / n, blanks / n, marks / n, stops / n, int(counts[124]) / n, rare / n, after / k,
        np.log1p(max(map(len, split), default=0)), len(zlib.compress(text, 1)) / n,
    ]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and x (array of NAMES) of every row; a null text counts as empty."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in hashing.slices(whole):
                raw = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
                rows = [statistics(t, w) for t, w in zip(raw, hashing.word_arrays([t.lower() for t in raw]), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return texts(docs).mapInArrow(measure, "doc_id bigint, x array<double>")


@dataclass(frozen=True)
class Features:
    """Standardisation and random projections; the same at every place that uses them."""

    mean: np.ndarray
    scale: np.ndarray
    cosines: int = COSINES
    seed: int = 11

    def __call__(self, x: np.ndarray) -> np.ndarray:
        draw = np.random.default_rng(self.seed)
        d = x.shape[1]
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = draw.normal(size=(d, self.cosines)) / np.sqrt(d)
        shift = draw.uniform(0, 2 * np.pi, self.cosines)
        return np.hstack((np.ones((len(x), 1)), z, np.sqrt(2 / self.cosines) * np.cos(z @ waves + shift)))


@dataclass(frozen=True)
class Model:
    features: Features | None
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.full(len(x), self.values[0])
        return np.interp(self.features(x) @ self.weights, self.knots, self.values)


def _stack(column) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, len(NAMES)))


def isotonic(at: np.ndarray, total: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (centres, means) of the blocks, means ascending."""
    blocks: list[list[float]] = []
    for a, t, c in zip(at, total, count, strict=True):
        blocks.append([a * c, t, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    x, t, c = np.array(blocks).T
    return x / c, t / c


def fit(x: DataFrame, labels: DataFrame, *, folds: int = FOLDS, ridge: float = RIDGE) -> Model:
    """Learn from the rows of ``x`` (doc_id, x) that ``labels`` (doc_id, quality 0 or 1) covers; all of them, none sampled.

    Without rows every score is 0.5, with one class it is that class's.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", F.col("quality").cast("double").alias("y")).dropDuplicates(["doc_id"])
    rows = written(x.join(known, "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(folds))), "labelled")
    d = len(NAMES)
    first = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y"), *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)], *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(d)]).first()
    if not first.n or first.y in (0.0, 1.0):
        return Model(None, np.empty(0), np.zeros(1), np.array([first.y if first.n else 0.5]))
    scale = np.array([first[f"s{i}"] for i in range(d)])
    features = Features(np.array([first[f"m{i}"] for i in range(d)]), np.where(scale > 1e-9, scale, 1.0))

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for f in frames:
            for fold, part in f.groupby("fold"):
                for a in range(0, len(part), 4096):
                    z = features(_stack(part.x.iloc[a : a + 4096]))
                    z = np.hstack((z, part.y.to_numpy()[a : a + 4096, None]))
                    total[fold] = total.get(fold, 0) + z.T @ z
        for fold, m in total.items():
            yield pd.DataFrame({"fold": fold, "i": np.arange(len(m)), "row": list(m)})

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": [key[0]], "i": [key[1]], "row": [np.sum(np.stack(part.row.to_numpy()), 0)]})

    schema = "fold bigint, i bigint, row array<double>"
    parts = rows.mapInPandas(sums, schema).groupBy("fold", "i").applyInPandas(add, schema).toPandas()
    size = d + COSINES + 2
    by_fold = np.zeros((folds, size, size))
    for fold, i, row in parts.itertuples(index=False):
        by_fold[fold, i] = row
    whole = by_fold.sum(0)

    def solved(m: np.ndarray) -> np.ndarray:
        keep = ridge * max(1.0, m[0, 0]) * np.eye(size - 1) / (size - 1)
        keep[0, 0] = 0
        return np.linalg.lstsq(m[:-1, :-1] + keep, m[:-1, -1], rcond=None)[0]

    weights = solved(whole)
    apart = np.stack([solved(whole - m) if (whole - m)[0, 0] else weights for m in by_fold])

    def seen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            raw = np.einsum("ij,ij->i", features(_stack(f.x)), apart[f.fold.to_numpy()]) if len(f) else np.empty(0)
            yield pd.DataFrame({"bin": np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int64), "y": f.y})

    # At most BINS rows, however many were labelled.
    bins = rows.mapInPandas(seen, "bin bigint, y double").groupBy("bin").agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).toPandas().sort_values("bin")
    knots, values = isotonic((bins.bin.to_numpy() + 0.5) * 2 / BINS - 0.5, bins.y.to_numpy(), bins.n.to_numpy())
    return Model(features, weights, knots, np.clip(values, 0, 1))


def scored(x: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``x``."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                at = np.asarray(part.column("x").flatten()).reshape(part.num_rows, -1)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.clip(model.score(at), 0, 1), pa.float64())], names=["doc_id", "score"])

    return x.mapInArrow(mark, "doc_id bigint, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and score of every row of ``docs``, learned from ``labels`` (doc_id, quality).

    A null text counts as empty and is scored like any other; repeated rows get a row each, a null doc_id stays
    null and is not learned from. Other columns are ignored; no rows give no rows.
    """
    x = written(measured(docs), "statistics")
    return scored(x, fit(x, labels))


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels are learned from the three quarters that are not held out."""
    out = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~held_out()))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
