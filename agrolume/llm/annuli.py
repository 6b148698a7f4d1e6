"""Exact top-k by inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it. Sorted by that key, runs of vectors are
annuli around their pivot: each knows its least and greatest distance and its longest vector. By the triangle
inequality no vector of an annulus is nearer to a query than the gap between the query's own distance to the pivot and the
annulus, and as |q - v|^2 = |q|^2 + |v|^2 - 2 q.v, that bounds the inner product. A search expands from the annuli
with the best bounds outwards and stops where no bound reaches the k-th score found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agrolume.llm.common import ship, table, written

TOP, SCALE, EVERY = 5, 256, 50
#: Larger components are held at it.
LIMIT = 2**62
#: Pivots are fitted on so many rows and components at most, the least by a hash of their vectors.
SAMPLE_ROWS, SAMPLE_CELLS = 4096, 4_000_000
MOST_PIVOTS, ROUNDS = 256, 6
#: Vectors and components of an annulus.
ANNULUS_ROWS, ANNULUS_CELLS = 512, 1 << 19
#: Annuli that a task searches at once, and the bytes of queries that are broadcast at once (a pass over the index each).
SHELF, QUERY_BYTES = 64, 8_000_000


@dataclass(frozen=True)
class Shape:
    """Facts of all vectors: components, and the type in which their inner products are exact."""

    width: int
    stored: str
    kind: type

    @classmethod
    def of(cls, width: int, most: int) -> Shape:
        stored = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
        peak = max(1, width) * most * most
        return cls(width, stored, np.float32 if peak < 2**22 else np.float64 if peak < 2**51 else object)

    def matrix(self, lists: pa.Array) -> np.ndarray:
        """Lists of integers as rows, shorter ones with zeros behind."""
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy()
        out = np.zeros((len(sizes), self.width), self.stored)
        out[np.arange(self.width) < sizes[:, None]] = flat
        return out

    def read(self, data: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(data), self.stored).reshape(-1, self.width) if self.width else np.zeros((len(data), 0), self.stored)

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """All inner products of the rows of a and b, exact."""
        if self.kind is object:
            return a.astype(object) @ b.astype(object).T
        return a.astype(self.kind) @ b.astype(self.kind).T

    def norms(self, a: np.ndarray) -> np.ndarray:
        wide = a.astype(object if self.kind is object else np.int64)
        return (wide * wide).sum(1)

    def distances(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distances of all rows of a to all of b; the squares are exact, so equal rows have equal distances."""
        square = self.norms(a)[:, None] + self.norms(b)[None, :] - 2 * (self.products(a, b) if self.kind is object else self.products(a, b).astype(np.int64))
        return np.sqrt(square.astype(np.float64))


def integer_vectors(vectors: DataFrame, *, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components as floor(scale * x); without rows that have no id, no vector, or a component that is null or not finite."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    known = vectors.where(F.col("vec_id").isNotNull() & F.col(column).isNotNull() & ~bad)
    return known.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(column, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(LIMIT)), F.lit(-LIMIT)).cast("bigint")).alias("v"))


def fit_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` pivots at most: seeds far from each other, then the means of what is nearest to each, as integers."""
    points = np.unique(sample, axis=0).astype(np.float64)
    chosen = [0]
    far = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(points)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
    pivots = points[chosen]
    norms = (points**2).sum(1)[:, None]
    for _ in range(ROUNDS):
        nearest = (norms - 2 * points @ pivots.T + (pivots**2).sum(1)).argmin(1)
        size = np.bincount(nearest, minlength=len(pivots))
        sums = np.zeros_like(pivots)
        np.add.at(sums, nearest, points)
        pivots = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], pivots)
    return np.clip(np.rint(pivots), -float(LIMIT), float(LIMIT))


def _annuli(keyed: DataFrame, shape: Shape) -> DataFrame:
    """Rows in order of pivot, distance, id and vector become annuli; a row that repeats the one before it is left out."""
    most = max(1, min(ANNULUS_ROWS, ANNULUS_CELLS // max(1, shape.width)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def annulus(rows: list[tuple]) -> pa.RecordBatch:
            norm = max(shape.norms(shape.read([r[3] for r in rows])).tolist())
            facts = [rows[0][0], rows[0][1], rows[-1][1], float(norm), np.array([r[2] for r in rows], "<i8").tobytes(), b"".join(r[3] for r in rows)]
            types = [pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(facts, types, strict=True)], names=["pivot", "lo", "hi", "norm", "ids", "vectors"])

        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("pivot", "dist", "vec_id", "v")], strict=True):
                if rows and row == rows[-1]:
                    continue
                if rows and (row[0] != rows[0][0] or len(rows) == most):
                    yield annulus(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield annulus(rows)

    order = ["pivot", "dist", "vec_id", "v"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, "pivot int, lo double, hi double, norm double, ids binary, vectors binary")


@dataclass
class Index:
    """The written annuli with what a search needs to know of them."""

    annuli: DataFrame
    pivots: np.ndarray
    shape: Shape


def build(vectors: DataFrame, *, pivots: int | None = None) -> Index | None:
    """An index over (vec_id, v), arrays of integers; None if there are no rows.

    Half the square root of the rows is the number of pivots, 256 at most.
    """
    spark = vectors.sparkSession
    ship(spark)
    facts = vectors.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    if not facts[0]:
        return None
    shape = Shape.of(facts[1], (facts[2] or 0) + 1)
    n = pivots or min(MOST_PIVOTS, max(1, math.ceil(math.sqrt(facts[0]) / 2)))
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_CELLS // max(1, shape.width)))
    sample = vectors.select("v").orderBy(F.xxhash64("v"), "v").limit(rows).toArrow().column("v").combine_chunks()
    centres = fit_pivots(shape.matrix(sample), n).astype(shape.stored)
    sent = spark.sparkContext.broadcast(centres)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                v = shape.matrix(batch.column("v"))
                dist = shape.distances(v, sent.value)
                nearest = dist.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(nearest, pa.int32()), pa.array(dist[np.arange(len(v)), nearest], pa.float64()), pa.array([r.tobytes() for r in v], pa.binary())],
                    names=["vec_id", "pivot", "dist", "v"],
                )

    keyed = vectors.mapInArrow(key, "vec_id bigint, pivot int, dist double, v binary")
    return Index(written(_annuli(keyed, shape), "annuli"), centres, shape)


class Search:
    """The k best of each query among the annuli that a task has seen so far."""

    def __init__(self, shape: Shape, pivots: np.ndarray, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, top: int):
        self.shape, self.ids, self.q, self.top = shape, ids, q, top
        self.floor = floor.astype(object if shape.kind is object else np.float64)  # the k-th score known of each query
        self.norm = shape.norms(q).astype(np.float64)
        self.to_pivot = shape.distances(q, pivots) if len(q) else np.zeros((0, len(pivots)))
        self.who = np.zeros(0, np.int64)
        self.found = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.float64 if shape.kind is not object else object)
        self.visits = 0

    def bounds(self, pivot: np.ndarray, lo: np.ndarray, hi: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """What a vector of each annulus can score with each query at most, rounding included."""
        d = self.to_pivot[:, pivot]
        gap = np.maximum(0, np.maximum(lo - d, d - hi))
        return (self.norm[:, None] + norm - gap * gap) / 2 + 1e-9 * (self.norm[:, None] + norm) + 1e-6

    def expand(self, pivot: np.ndarray, lo: np.ndarray, hi: np.ndarray, norm: np.ndarray, ids: list[np.ndarray], vectors: list[np.ndarray]) -> None:
        """Search some annuli: each query the one with its best bound first, then twice as many in each step until no bound is high enough."""
        bound = self.bounds(pivot, lo, hi, norm)
        place = np.empty_like(bound, dtype=np.int64)
        np.put_along_axis(place, np.argsort(-bound, axis=1, kind="stable"), np.arange(len(pivot))[None, :], 1)
        first, size = 0, 1
        while first < len(pivot):
            now = (place >= first) & (place < first + size) & (bound >= self.floor[:, None])
            for a in np.flatnonzero(now.any(0)).tolist():
                self.visit(np.flatnonzero(now[:, a]), ids[a], vectors[a])
            self.keep_best()
            first, size = first + size, 2 * size

    def visit(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.visits += len(rows)
        score = self.shape.products(self.q[rows], vectors)
        at, col = np.nonzero(score >= self.floor[rows][:, None])
        own = self.ids[rows[at]] == ids[col]
        own[own] = (self.q[rows[at[own]]] == vectors[col[own]]).all(1)
        at, col = at[~own], col[~own]
        self.who = np.concatenate((self.who, rows[at]))
        self.found = np.concatenate((self.found, ids[col]))
        self.score = np.concatenate((self.score, score[at, col].astype(self.score.dtype)))

    def keep_best(self) -> None:
        order = np.lexsort((self.found, -self.score, self.who)) if self.shape.kind is not object else np.array(sorted(range(len(self.who)), key=lambda i: (self.who[i], -self.score[i], self.found[i])), np.int64)
        who = self.who[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        order = order[rank < self.top]
        self.who, self.found, self.score = self.who[order], self.found[order], self.score[order]
        last = rank[rank < self.top] == self.top - 1
        self.floor[self.who[last]] = np.maximum(self.floor[self.who[last]], self.score[last])


def _shelves(batches: Iterator[pa.RecordBatch], shape: Shape) -> Iterator[tuple]:
    for whole in batches:
        for at in range(0, whole.num_rows, SHELF):
            batch = whole.slice(at, SHELF)
            facts = [batch.column(c).to_numpy() for c in ("pivot", "lo", "hi", "norm")]
            ids = [np.frombuffer(x, "<i8") for x in batch.column("ids").to_pylist()]
            yield *facts, ids, [np.frombuffer(x, shape.stored).reshape(len(i), shape.width) for i, x in zip(ids, batch.column("vectors").to_pylist(), strict=True)]


def own_annulus(index: Index, every: int, top: int) -> DataFrame:
    """(vec_id, v, floor) of each query, a vector whose id ``every`` divides; floor: its k-th score within its own annulus, if that has so many."""
    shape = index.shape

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, ids, vectors in _shelves(batches, shape):
            for i, v in zip(ids, vectors, strict=True):
                at = np.flatnonzero(i % every == 0)
                if not len(at):
                    continue
                score = shape.products(v[at], v)
                score[np.arange(len(at)), at] = np.iinfo(np.int64).min if shape.kind is object else -np.inf
                floors = [int(x) for x in np.sort(score, axis=1)[:, -top]] if len(i) > top else [None] * len(at)
                yield pa.RecordBatch.from_arrays([pa.array(i[at], pa.int64()), pa.array([r.tobytes() for r in v[at]], pa.binary()), pa.array([None if f is None else max(-(2**62), min(2**62, f)) for f in floors], pa.int64())], names=["vec_id", "v", "floor"])

    return index.annuli.mapInArrow(look, "vec_id bigint, v binary, floor bigint")


def nearest(index: Index, *, every: int = EVERY, top: int = TOP, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score for every vector whose id ``every`` divides; each pass over the index takes a bounded number of them."""
    spark, shape, pivots = index.annuli.sparkSession, index.shape, index.pivots
    queries = own_annulus(index, every, top)
    queries = written(queries.withColumn("q", F.monotonically_increasing_id()), "queries")
    passes = max(1, math.ceil(queries.count() * (16 + 8 * shape.width) / query_bytes))
    out = spark.createDataFrame([], "q bigint, query_id bigint, vec_id bigint, score bigint")
    for k in range(passes):
        some = queries.where(F.pmod(F.xxhash64("q"), F.lit(passes)) == k).select("q", "vec_id", "v", "floor").toArrow()
        if not some.num_rows:
            continue
        floor = np.array([-(2.0**63) if f is None else f for f in some.column("floor").to_pylist()], object)
        sent = spark.sparkContext.broadcast((some.column("q").to_numpy(), some.column("vec_id").to_numpy(), shape.read(some.column("v").to_pylist()), floor))

        def expand(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            q, ids, vectors, floor = sent.value
            search = Search(shape, pivots, ids, vectors, floor, top)
            for shelf in _shelves(batches, shape):
                search.expand(*shelf)
            score = [max(-(2**63), min(2**63 - 1, int(s))) for s in search.score.tolist()]
            columns = [q[search.who], ids[search.who], search.found, score]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["q", "query_id", "vec_id", "score"])

        out = out.unionByName(written(index.annuli.mapInArrow(expand, out.schema), "found"))
        sent.unpersist()
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, *, column: str = "embedding", every: int = EVERY, top: int = TOP, scale: int = SCALE, pivots: int | None = None, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose vec_id ``every`` divides, the ``top`` other vectors of the highest inner product.

    Components count as floor(scale * x); equal scores go by ascending vec_id. A null id, a null vector, or one with a null or
    non-finite component takes no part. An empty vector scores 0 with all; a shorter one counts as having zeros
    behind. Rows equal in id and vector are one; rows of one id with different vectors are queries and candidates each,
    only the query's own row is no candidate. Components beyond 2^62 and scores beyond 64 bits are held at the limit. Other columns are
    ignored. No rows give no rows, a query without another vector gives none.
    """
    index = build(integer_vectors(vectors, column=column, scale=scale), pivots=pivots)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return nearest(index, every=every, top=top, query_bytes=query_bytes)


def op13_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all other vectors for every fiftieth one."""
    return top_k(table(spark, sf_dir, "embeddings"))


OP13_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {TOP}
"""
