"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded text.

Folding undoes disguises: letters of other scripts that look like Latin ones, and
digits or signs that stand for letters inside a word. The text becomes words
with one blank between them, so a term matches at the start of a word and may
end inside it. Phrases that are known to be harmless silence the terms inside
them. The weights of what is left are summed and set against the length.

Terms, weights and phrases are learned from labelled texts: a term's weight is
the logarithm of its odds in toxic against other documents.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.llm.common import ship, table, texts

#: Labelled documents of each class that a fit reads at most: the classifier's documented sample.
PER_CLASS = 10_000
#: A term must begin words of this share of the sample's toxic documents: so at most 1 / SHARE times a document's terms qualify.
SHARE = 0.004
LEAST, SHORTEST, LONGEST = 3, 3, 10
#: How surprising a term's counts must be, in standard deviations.
SURE = 4.5
#: Letters that look alike (Cyrillic and Greek as Latin), then digits and signs used for letters.
LOOK_ALIKE = dict(zip("авеёзікмнорстухѕјһԁԛԝοαενικρτυχ", "abee3ikmhopctyxsjhdqwoaevikptux", strict=True))
FOR_LETTERS = dict(zip("013457@$!|", "oieastasil", strict=True))
#: Harmless phrases that hold a word of abuse.
PHRASES = ("clown fish", "trash can", "trash bin", "pond scum", "idiot proof", "loser bracket")

_WORD = re.compile(r"[^\W_]+(?:[@$!|]+[^\W_]+)*")
_LOOK = str.maketrans(LOOK_ALIKE)
_LETTERS = str.maketrans(FOR_LETTERS)
_SIGNS = re.compile(r"[013457@$!|]")


def _word(word: str) -> str:
    """Digits and signs as letters, if the word has letters at all."""
    return word.translate(_LETTERS) if any(c.isalpha() for c in word) else word


def fold(text: str) -> list[str]:
    """The words of a text as the lexicon sees them."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower().translate(_LOOK)
    else:
        text = text.lower()
    found = _WORD.findall(text)
    return [_word(w) if _SIGNS.search(w) else w for w in found]


@dataclass(frozen=True)
class Model:
    """Terms (the beginning of a word) with weights, harmless phrases, and the curve from features to a score."""

    weights: dict[str, float]
    phrases: tuple[str, ...]
    curve: tuple[float, ...] = (0.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for p in self.phrases:
            a.add_word(f" {p} ", (True, len(p) + 2, 0.0))
        for t, w in self.weights.items():
            a.add_word(f" {t}", (False, len(t) + 1, w))
        a.make_automaton()
        return a


def hits(automaton: ahocorasick.Automaton, folded: str) -> dict[int, tuple[float, int]]:
    """Start of each hit word: (weight of its longest term, that term's length), without those inside a harmless phrase."""
    found: dict[int, tuple[float, int]] = {}
    spans = []
    for last, (phrase, n, weight) in automaton.iter(folded) if len(automaton) else ():
        start = last + 1 - n
        if phrase:
            spans.append((start, last))
        elif n > found.get(start, (0.0, 0))[1]:
            found[start] = (weight, n)
    for a, b in spans:
        for s in [s for s in found if a <= s < b]:
            del found[s]
    return found


def features(weight: float, words: int) -> tuple[float, float, float]:
    """1, the summed weight on a log scale, and the weight against the length."""
    return 1.0, float(np.log1p(weight)), weight / (words + 20.0) ** 0.5


def _surprise(a: float, b: float, n: float, m: float) -> float:
    """Root of the likelihood ratio statistic of a in n against b in m."""
    p = (a + b) / (n + m)
    cells = ((a, n * p), (n - a, n * (1 - p)), (b, m * p), (m - b, m * (1 - p)))
    return float(np.sqrt(max(0.0, 2 * sum(o * np.log(o / e) for o, e in cells if o > 0 and e > 0))))


def _terms(words: list[str]) -> set[str]:
    return {w[:n] for w in set(words) for n in range(SHORTEST, min(LONGEST, len(w)) + 1)}


def _counted(rows: DataFrame, terms) -> DataFrame:
    """(term, toxic, clean): in how many texts of each class a term occurs; counts leave a task when they take room."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            keys = list(seen[0].keys() | seen[1].keys())
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([seen[1][k] for k in keys], pa.int64()), pa.array([seen[0][k] for k in keys], pa.int64())], names=["term", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                seen[toxic].update(terms(fold(text.as_py())))
                if len(seen[0]) + len(seen[1]) > 300_000:
                    yield out()
                    seen = (Counter(), Counter())
        yield out()

    return rows.select("text", "toxic").mapInArrow(count, "term string, toxic bigint, clean bigint").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def labelled(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """text and toxic of at most per_class documents of each class, chosen by a hash of their id; the size of each class."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropDuplicates(["doc_id"])
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id", F.lit("sample"))
    some = [known.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(per_class) for c in (0, 1)]
    # Bounded: at most two times per_class ids.
    return texts(docs).join(F.broadcast(some[0].unionByName(some[1])), "doc_id"), sizes


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, phrases: tuple[str, ...] = PHRASES) -> Model:
    """Learn a model from the documents that ``labels`` (doc_id, toxic 0 or 1) covers; others are not read by it.

    Without toxic or without clean documents the lexicon is empty and every score is the share of toxic ones.
    """
    rows, sizes = labelled(docs, labels, per_class)
    n = {c: min(per_class, sizes.get(c, 0)) for c in (0, 1)}
    base = float(np.log((sizes.get(1, 0) + 0.5) / (sizes.get(0, 0) + 0.5)))
    if not n[0] or not n[1]:
        return Model({}, phrases, (base, 0.0, 0.0))

    def weight(toxic, clean):
        return np.log((toxic + 0.5) / (n[1] + 1)) - np.log((clean + 0.5) / (n[0] + 1))

    least = max(LEAST, SHARE * n[1])
    # The share of toxic documents bounds how many terms can pass.
    counted = _counted(rows, _terms).where((F.col("toxic") >= least) & (F.col("toxic") / n[1] > 3 * F.col("clean") / n[0])).toPandas()
    # Of terms that begin the same words the longest says it best.
    support = dict(zip(counted.term, counted.toxic, strict=True))
    longer = {t[:-1] for t, toxic in support.items() if toxic >= 0.95 * support.get(t[:-1], np.inf)}
    terms = {}
    for t, toxic, clean in sorted(counted.itertuples(index=False), key=lambda r: (len(r[0]), r[0])):
        if t in longer:
            continue
        w = float(weight(toxic, clean))
        shorter = max((terms[t[:k]] for k in range(SHORTEST, len(t)) if t[:k] in terms), default=0.0)
        if w > shorter + 0.7 and _surprise(toxic, clean, n[1], n[0]) >= SURE:
            terms[t] = w
    model = Model(terms, phrases)
    automaton = model.automaton()

    def around(words: list[str]) -> set[str]:
        """Pairs of neighbouring words of which one is hit."""
        said = f" {' '.join(words)} "
        at = np.cumsum([0, *[len(w) + 1 for w in words]])
        index = {int(a): i for i, a in enumerate(at)}
        found = [index[s] for s in hits(automaton, said)]
        return {f"{words[i]} {words[i + 1]}" for j in found for i in (j - 1, j) if 0 <= i < len(words) - 1}

    # A pair in at least 3 clean documents and no toxic one is harmless; the share bounds how many there are.
    harmless = _counted(rows, around).where((F.col("toxic") == 0) & (F.col("clean") >= max(LEAST, SHARE * n[0]))).select("term").toPandas().term
    model = Model(terms, (*phrases, *sorted(set(harmless) - set(phrases))))
    marked = rows.mapInPandas(_marker(model), "toxic int, weight double, words bigint").toPandas()
    x = np.array([features(w, m) for w, m in zip(marked.weight, marked.words, strict=True)])
    y = marked.toxic.to_numpy(float)
    if not 0 < y.sum() < len(y):  # the labelled documents are not here
        return Model({}, phrases, (base, 0.0, 0.0))
    importance = np.where(y == 1, sizes[1] / max(1, (y == 1).sum()), sizes[0] / max(1, (y == 0).sum()))
    return Model(model.weights, model.phrases, tuple(_logistic(x, y, importance / importance.mean())))


def _marker(model: Model):
    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = model.automaton()
        for f in frames:
            out = []
            for text in f.text:
                words = fold(text)
                out.append((sum(w for w, _ in hits(automaton, f" {' '.join(words)} ").values()), len(words)))
            yield pd.DataFrame({"toxic": f.toxic, "weight": [w for w, _ in out], "words": [n for _, n in out]})

    return mark


def _logistic(x: np.ndarray, y: np.ndarray, importance: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    b = np.zeros(x.shape[1])
    keep = np.diag([1e-9, *[ridge] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (importance * p * (1 - p))[:, None]).T @ x + keep + 1e-9 * np.eye(len(b)), x.T @ (importance * (y - p)) - keep @ b)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return b


def _scores(texts_: list[str], model: Model, automaton: ahocorasick.Automaton) -> Iterator[tuple[float, int]]:
    curve = np.array(model.curve)
    for text in texts_:
        words = fold(text)
        found = hits(automaton, f" {' '.join(words)} ")
        z = float(np.dot(curve, features(sum(w for w, _ in found.values()), len(words))))
        yield float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0)))), len(found)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and hits (words that count) of every row.

    A null or empty text has no hits: its score is the curve's value at 0. Repeated rows get a row each, a null doc_id
    stays null, other columns are ignored, no rows give no rows.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            found = list(_scores(batch.column("text").to_pylist(), model, automaton))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s for s, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64())], names=["doc_id", "score", "hits"])

    return texts(docs).mapInArrow(mark, "doc_id bigint, score double, hits bigint")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold; a null text counts as empty. Nothing is shuffled."""
    ship(docs.sparkSession)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            found = _scores([t or "" for t in batch.column("text").to_pylist()], model, automaton)
            yield batch.filter(pa.array([s < threshold for s, _ in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def held_out(folds: int, which: int):
    return F.crc32(F.col("doc_id").cast("string")) % folds == which


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; labels are learned from four fifths of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out(5, 0)))
    return score(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits")
