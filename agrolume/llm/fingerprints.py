"""Document fingerprints by SimHash, and search within a Hamming radius by permuted block tables.

Terms are a text's word pairs; each votes with its weight on every bit of the
fingerprint, for its hash bit. Fingerprints near each other share at least one of
radius + 1 blocks of bits (pigeonhole). Each table leads with one block, and rows
meet by an equi-join on it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from agrolume.llm import hashing
from agrolume.llm.common import table, texts, written

BITS = 128
RADIUS = 3
#: Votes counted together: bounds the bit matrix of a step.
VOTES = 65_536


def _votes(terms: np.ndarray, weights: np.ndarray, bits: int) -> np.ndarray:
    """Weighted sum of +1 for a set bit and -1 for a clear one, over the hashes of terms."""
    total = np.zeros(bits, np.float32)
    for a in range(0, len(terms), VOTES):
        t, w = terms[a : a + VOTES], weights[a : a + VOTES]
        for k in range(bits // 64):
            h = hashing.mix(t + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64))
            bit = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total[64 * k : 64 * k + 64] += 2 * (w @ bit) - w.sum()
    return total


def simhash(hashes: np.ndarray, bits: int = BITS) -> bytes:
    """Fingerprint of a text from its word hashes; without words all bits are clear. Ties are clear bits."""
    terms, counts = np.unique(hashing.shingles(hashes, 2), return_counts=True)
    if not len(terms):
        return bytes(bits // 8)
    return np.packbits(_votes(terms, 1 + np.log(counts, dtype=np.float32), bits) > 0).tobytes()


def fingerprint_all(texts_: list[str], bits: int = BITS) -> list[bytes]:
    encoded = [t.encode("utf-8", "surrogatepass").lower() for t in texts_]
    return [simhash(h, bits) for h in hashing.word_arrays(encoded)]


def fingerprints(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id and fingerprint (binary) of every row; a null or blank text has all bits clear. Equal texts have equal ones."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprint_all(batch.column(1).to_pylist(), bits), pa.binary())], names=["doc_id", "fingerprint"])

    return texts(docs).mapInArrow(mark, "doc_id bigint, fingerprint binary")


def distance(a: Column, b: Column, bits: int = BITS) -> Column:
    """Bits in which two fingerprints (hexadecimal strings) differ."""
    words = [F.bit_count(F.conv(F.substring(a, k, 8), 16, 10).cast("bigint").bitwiseXOR(F.conv(F.substring(b, k, 8), 16, 10).cast("bigint"))) for k in range(1, bits // 4, 8)]
    return sum(words[1:], words[0])


def _tables(df: DataFrame, column: str, radius: int, bits: int) -> DataFrame:
    """A row per block table: the table's number and its leading block."""
    digits = bits // 4
    edges = [round(i * digits / (radius + 1)) for i in range(radius + 2)]
    rows = F.array(*[F.struct(F.lit(i).alias("table"), F.substring(column, a + 1, b - a).alias("block")) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))])
    return df.select("*", F.explode(rows).alias("x")).select(*df.columns, "x.table", "x.block")


def within(queries: DataFrame, corpus: DataFrame, *, radius: int = RADIUS, bits: int = BITS) -> DataFrame:
    """(query, fingerprint, distance): every fingerprint of the corpus within ``radius`` of each query, exactly.

    Both have ``fingerprint`` (hexadecimal string of ``bits`` bits), each value at most once; nulls find nothing.
    """
    left = _tables(queries.select(F.col("fingerprint").alias("query")), "query", radius, bits)
    right = _tables(corpus.select("fingerprint"), "fingerprint", radius, bits)
    met = left.join(right, ["table", "block"])
    return met.withColumn("distance", distance(F.col("query"), F.col("fingerprint"), bits)).where(F.col("distance") <= radius).select("query", "fingerprint", "distance").distinct()


def _cuts(docs: DataFrame, parts: int) -> np.ndarray:
    """The first id of all and the ids that begin further parts of the id order: as many as parts, however many rows."""
    at = [i / parts for i in range(1, parts)]
    row = docs.agg(F.min("doc_id").alias("first"), F.percentile_approx("doc_id", at, 10_000).alias("cuts")).first()
    return np.array([] if row.first is None else sorted({row.first, *row.cuts}), np.int64)


def edited(docs: DataFrame, *, bits: int = BITS, parts: int | None = None) -> DataFrame:
    """Each document against an edited text and the next document, in ascending order of doc_id.

    The edited text has the last floor(n / 2) code points replaced by the first as many of the next document
    (or all it has); after the last comes the first. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next (shares of equal bits); fingerprints are hexadecimal.
    A null or empty text is the empty text. Each row is a document: rows of one doc_id follow each other by their
    text, a row without doc_id is its own next one. Other columns are ignored, no rows give no rows.
    """
    rows = texts(docs)
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = _cuts(rows, max(2, parts))

    @F.pandas_udf(ArrayType(LongType()))
    def places(ids: pd.Series) -> pd.Series:
        """Twice the part of a row; plus 1 for a copy of the row at the end of the part before, if it begins a part."""
        known = ids.notna().to_numpy()
        values = ids.fillna(0).to_numpy().astype(np.int64)
        part = np.searchsorted(cuts, values, side="right") - 1
        begins = known & (cuts[np.maximum(part, 0)] == values) if len(cuts) else known
        before = 2 * ((part - 1) % max(1, len(cuts))) + 1
        return pd.Series([[2 * p, b] if s else [2 * p] if k else [-2] for p, b, s, k in zip(part.tolist(), before.tolist(), begins.tolist(), known.tolist(), strict=True)])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row, until its next one is known
        for whole in batches:
            for batch in hashing.slices(whole):
                rows = list(zip(batch.column("place").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True))
                prints = fingerprint_all([t for _, _, t in rows], bits)
                out: list[tuple] = []
                for (place, doc, text), print_ in zip(rows, prints, strict=True):
                    if place < 0:
                        out.append((doc, text, print_, text, print_))
                        continue
                    if held and held[0] >> 1 == place >> 1:
                        out.append((*held[1:], text, print_))
                        held = None
                    if place % 2 == 0:
                        held = (place, doc, text, print_)
                yield _judged(out, bits)

    # A part ends with a copy of the row that begins the next one, the last part with the first row of all.
    placed = rows.withColumn("place", F.explode(places("doc_id"))).repartition(max(2, parts), F.floor(F.col("place") / 2))
    ordered = placed.sortWithinPartitions("place", "doc_id", "text")
    return ordered.select("place", "doc_id", "text").mapInArrow(pair, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _judged(rows: list[tuple], bits: int) -> pa.RecordBatch:
    changed = []
    for _, text, _, following, _ in rows:
        half = len(text) // 2
        changed.append(text[: len(text) - half] + following[:half])
    prints = fingerprint_all(changed, bits)

    def alike(a: bytes, b: bytes) -> float:
        return 1 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / bits

    columns = {
        "doc_id": pa.array([r[0] for r in rows], pa.int64()),
        "n_chars": pa.array([len(r[1]) for r in rows], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed], pa.string()),
        "fingerprint": pa.array([r[2].hex() for r in rows], pa.string()),
        "edited_fingerprint": pa.array([p.hex() for p in prints], pa.string()),
        "near_edited": pa.array([alike(r[2], p) for r, p in zip(rows, prints, strict=True)], pa.float64()),
        "near_next": pa.array([alike(r[2], r[4]) for r in rows], pa.float64()),
    }
    return pa.RecordBatch.from_pydict(columns)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts; for ids divisible by 100 also how many documents lie within the radius (with itself)."""
    rows = written(edited(table(spark, sf_dir, "documents")), "fingerprints")
    known = written(rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("copies"), F.max(F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False))).alias("asked")), "known")
    near = within(known.where("asked"), known).join(known, "fingerprint").groupBy("query").agg(F.sum("copies").alias("n_near"))
    return rows.join(near, F.col("fingerprint") == F.col("query"), "left").withColumn("n_near", F.when(F.col("doc_id") % 100 == 0, F.col("n_near"))).drop("query")
