"""Ranked lexical search: accumulator-limited term-at-a-time over partitions of the documents.

The corpus is read once into forward rows (document, its length, its occurrences of terms that any item
asks for); counts over all of them give each term its weight. A task then holds a bounded block of documents at a
time, inverted, and answers every item term by term, the rarest first. A document gets an accumulator when a term
meets it, until what the remaining terms can add at most is less than the k-th partial score: no new document can
come among the first k any more, so later terms only go on adding to the accumulators that exist. Scores are exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agrolume.llm.common import ship, table, written

TOP = 10
#: Bytes of item texts searched in one pass over the corpus: bounds the terms that are broadcast.
PASS_BYTES = 4_000_000
#: Documents and postings of a block: bound the arrays of a task. One document more may lie over the second.
BLOCK_DOCS, BLOCK_POSTINGS = 65_536, 4_000_000
#: Bytes of a long text that are cut into terms at once.
PIECE = 1 << 20

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_SPACE = 32
#: Digits, letters (A-Z folded) and all bytes of other code points belong to terms; the rest is blank.
_FOLD = bytes(c if c >= 128 else ord(chr(c).lower()) if chr(c).isalnum() else _SPACE for c in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, piece by piece; no term is cut."""
    folded = text.translate(_FOLD)
    at = 0
    while at < len(folded):
        end = at + PIECE
        if end < len(folded):
            end = folded.find(b" ", end)
            end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _binary_text(df: DataFrame, key: str) -> DataFrame:
    ship(df.sparkSession)
    return df.where(F.col(key).isNotNull()).select(key, F.col("text").cast("binary").alias("text"))


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the different terms of each item; rows of one item_id are one item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, t) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for t in {t for piece in _pieces(text or b"") for t in piece}]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["item_id", "term"])

    return _binary_text(items, "item_id").mapInArrow(cut, "item_id bigint, term binary").distinct()


def forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms with repeats), ids and tfs of the terms in the vocabulary, for documents that have a term."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for batch in batches:
            doc_ids, sizes, edges, ids, tfs = [], [], [0], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n, found = 0, Counter()
                for terms in _pieces(text.as_py() or b""):
                    n += len(terms)
                    found.update(map(get, terms))
                if n:
                    found.pop(None, None)
                    doc_ids.append(doc)
                    sizes.append(n)
                    ids.extend(found.keys())
                    tfs.extend(found.values())
                    edges.append(len(ids))
            edges_ = pa.array(edges, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(edges_, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(edges_, pa.array(tfs, pa.int64()))],
                names=["doc_id", "n", "ids", "tfs"],
            )

    return _binary_text(docs, "doc_id").mapInArrow(count, "doc_id bigint, n bigint, ids array<int>, tfs array<bigint>")


@dataclass(frozen=True)
class Request:
    """What every task needs: each item's terms, the rarest first, the terms' weights and the counts of the corpus."""

    items: list[tuple[int, np.ndarray]]
    weight: np.ndarray
    documents: int
    occurrences: int
    top: int


class Block:
    """Postings of some documents by term, and the search over them."""

    def __init__(self, request: Request, doc_ids: np.ndarray, sizes: np.ndarray, counts: np.ndarray, ids: np.ndarray, tfs: np.ndarray):
        self.doc_ids = doc_ids
        long = 100 - 90 + (90 * sizes * request.documents) // request.occurrences
        order = np.argsort(ids, kind="stable")
        self.doc = np.repeat(np.arange(len(doc_ids)), counts)[order]
        tfs, ids = tfs[order], ids[order]
        self.impact = request.weight[ids] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * long[self.doc]))
        self.edges = np.searchsorted(ids, np.arange(len(request.weight) + 1))
        self.most = np.zeros(len(request.weight), np.int64)
        held = np.flatnonzero(np.diff(self.edges))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.impact, self.edges[held])
        self.score = np.zeros(len(doc_ids), np.int64)
        self.created = np.zeros(len(doc_ids), bool)

    def search(self, terms: np.ndarray, top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, doc_ids) of the ``top`` best of this block, none below ``floor``: the k-th score that is known from elsewhere."""
        terms = terms[self.most[terms] > 0]
        left = np.cumsum(self.most[terms][::-1])[::-1]
        made: list[np.ndarray] = []
        n_made, growing = 0, True
        for term, most_left in zip(terms.tolist(), left.tolist(), strict=True):
            docs, impact = self.doc[self.edges[term] : self.edges[term + 1]], self.impact[self.edges[term] : self.edges[term + 1]]
            if growing and made:
                kth = floor
                if n_made >= top and kth <= most_left:
                    partial = self.score[np.concatenate(made)]
                    kth = max(kth, int(np.partition(partial, n_made - top)[n_made - top]))
                growing = kth <= most_left
            elif growing:
                growing = floor <= most_left
            if growing:
                new = docs[~self.created[docs]]
                self.created[new] = True
                made.append(new)
                n_made += len(new)
            else:
                live = self.created[docs]
                docs, impact = docs[live], impact[live]
            self.score[docs] += impact
        at = np.concatenate(made) if made else np.zeros(0, np.int64)
        scores, ids = self.score[at], self.doc_ids[at]
        self.score[at], self.created[at] = 0, False
        return best(scores, ids, top, max(floor, 1))


def best(scores: np.ndarray, ids: np.ndarray, top: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` highest scores of at least ``least``, equal ones by ascending id."""
    if len(scores) > top:
        least = max(least, int(np.partition(scores, len(scores) - top)[len(scores) - top]))
    keep = scores >= least
    scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))[:top]
    return scores[order], ids[order]


def _blocks(batches: Iterator[pa.RecordBatch], request: Request) -> Iterator[Block]:
    def block(held: list[tuple]) -> Block:
        return Block(request, *[np.concatenate(x) for x in zip(*held, strict=True)])

    held, docs, postings = [], 0, 0
    for batch in batches:
        ids, tfs = batch.column("ids"), batch.column("tfs")
        counts = np.diff(ids.offsets.to_numpy())
        run = np.cumsum(counts)
        doc_ids, sizes = batch.column("doc_id").to_numpy(), batch.column("n").to_numpy()
        flat, flat_tfs = ids.flatten().to_numpy(), tfs.flatten().to_numpy()
        at = 0
        while at < len(counts):
            before = int(run[at - 1]) if at else 0
            end = min(len(counts), at + BLOCK_DOCS - docs, max(at + 1, int(np.searchsorted(run, before + BLOCK_POSTINGS - postings, side="right"))))
            last = int(run[end - 1])
            held.append((doc_ids[at:end], sizes[at:end], counts[at:end], flat[before:last], flat_tfs[before:last]))
            docs, postings, at = docs + end - at, postings + last - before, end
            if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS or at < len(counts):
                yield block(held)
                held, docs, postings = [], 0, 0
    if held:
        yield block(held)


def answers(rows: DataFrame, request: Request) -> DataFrame:
    """(item_id, doc_id, score): the best of each task for each item, among them the best of all."""
    sent = rows.sparkSession.sparkContext.broadcast(request)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        request = sent.value
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(request.items)
        for block in _blocks(batches, request):
            for i, (_, terms) in enumerate(request.items):
                scores, ids = found[i]
                floor = int(scores[-1]) if len(scores) == request.top else 0
                more, more_ids = block.search(terms, request.top, floor)
                if len(more):
                    found[i] = best(np.concatenate((scores, more)), np.concatenate((ids, more_ids)), request.top, 1)
        sizes = [len(s) for s, _ in found]
        columns = [np.repeat([i for i, _ in request.items], sizes), np.concatenate([d for _, d in found]), np.concatenate([s for s, _ in found])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    return rows.mapInArrow(search, "item_id bigint, doc_id bigint, score bigint")


def ranked(docs: DataFrame, items: DataFrame, *, top: int = TOP, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item with a score above 0, equal scores by ascending doc_id.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are ignored. Terms are runs of digits, letters and
    code points above 127, A-Z lower-cased. Each row of ``docs`` is a document, also where a doc_id repeats; rows of one item_id are
    one item with the terms of all. A null or empty text has no terms, and then an item finds nothing. A row without its id takes no part.
    Texts of any length are counted whole, in pieces. No documents or no items give no rows. Documents are read once a
    pass; a pass takes as many items as have ``pass_bytes`` of text (one item may have more).
    """
    spark = docs.sparkSession
    asked = items.where("item_id is not null and text is not null").select("item_id", "text")
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(total / pass_bytes))
    out = spark.createDataFrame([], "item_id bigint, doc_id bigint, score bigint")
    for k in range(passes):
        pairs = item_terms(asked.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k)).collect()
        if not pairs:
            continue
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(r.term) for r in pairs}))}
        rows = written(forward(docs, vocabulary), "forward")
        size = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = np.zeros(len(vocabulary), np.int64)
        for r in rows.select(F.explode("ids").alias("id")).groupBy("id").count().collect():  # as many as the pass has terms
            df[r.id] = r["count"]
        if not size[0]:
            continue
        weight = np.array([math.floor(1000 * math.log((2 * size[0] + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        terms: dict[int, list[int]] = {}
        for r in pairs:
            terms.setdefault(r.item_id, []).append(vocabulary[bytes(r.term)])
        rarest = [(i, np.array(sorted(t, key=lambda x: (df[x], x)))) for i, t in sorted(terms.items())]
        out = out.unionByName(written(answers(rows, Request(rarest, weight, size[0], size[1], top)), "answers"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of all for each benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = f"regexp_extract_all(translate(text, '{_LETTERS.upper()}', '{_LETTERS}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents WHERE doc_id IS NOT NULL),
e AS (SELECT r, doc_id, t, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS occ FROM e),
p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM e) GROUP BY ALL),
i AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL)),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, c GROUP BY term, docs),
s AS (SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // occ))))::BIGINT AS score
    FROM i JOIN p USING (term) JOIN w USING (term) JOIN e USING (r), c GROUP BY item_id, r),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s JOIN e USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= {TOP}
"""
