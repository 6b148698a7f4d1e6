"""Near-duplicate documents by SuperMinHash, banding, exact verification and connected groups.

A document is the set of its k-word shingles, as 64-bit hashes. SuperMinHash gives
each element a permutation of the signature's slots and rank-dependent values
(rank j lies in [j, j + 1)), so slots are correlated and estimates vary less than
with independent hashes; once all slots are filled, higher ranks cannot lower
them and the work stops. Equal bands of a signature make candidates, and every
link is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.llm import graph, hashing
from agrolume.llm.common import table, texts, written

SLOTS = 128
#: Slots in a band: of 32 bands, two sets of similarity 0.8 miss all with probability 5e-8.
ROWS = 4
#: Elements signed together.
STEP = 32_768
#: 64-bit words of the sketch that rules out pairs before their sets are read.
SKETCH = 16


def superminhash(elements: np.ndarray, owner: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (n, slots) of n sets: ``owner`` says whose each element is. A set without elements keeps infinity."""
    out = np.full(n * slots, np.inf)
    order = np.empty((0, 0), np.uint8)
    alive = np.arange(len(elements))
    for rank in range(slots):
        filled = np.isfinite(out).reshape(n, slots).all(1)
        keep = ~filled[owner[alive]]
        alive = alive[keep]
        if not len(alive):
            break
        if rank == 1:
            order = np.tile(np.arange(slots, dtype=np.int16), (len(alive), 1))
            order[:, 0] = first[keep]
            order[np.arange(len(alive)), first[keep]] = 0
        elif rank > 1:
            order = order[keep]
        bits = hashing.mix(elements[alive] + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 % 2**64))
        value = rank + (bits >> np.uint64(11)).astype(np.float64) / 2.0**53
        # Fisher-Yates, one step for all elements: swap the place of this rank with a later one.
        place = (rank + hashing.mix(bits) % np.uint64(slots - rank)).astype(np.int64)
        if rank == 0:
            first = slot = place
        else:
            rows = np.arange(len(alive))
            slot = order[rows, place].astype(np.int64)
            order[rows, place] = order[:, rank]
            order[:, rank] = slot
        np.minimum.at(out, owner[alive] * slots + slot, value)
    return out.reshape(n, slots)


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """Signatures of many sets, some thousands of elements at a time; a long set is signed in parts."""
    out = np.full((len(sets), slots), np.inf)
    held: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    size = 0

    def sign() -> None:
        at, owner = np.unique(np.concatenate(owners), return_inverse=True)
        out[at] = np.minimum(out[at], superminhash(np.concatenate(held), owner, len(at), slots))

    for i, s in enumerate(sets):
        for a in range(0, len(s), STEP):
            part = s[a : a + STEP]
            held.append(part)
            owners.append(np.full(len(part), i))
            size += len(part)
            if size >= STEP:
                sign()
                held, owners, size = [], [], 0
    if size:
        sign()
    return out


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), -1, rows)
    key = np.broadcast_to(np.arange(1, bits.shape[1] + 1, dtype=np.uint64), bits.shape[:2])
    for r in range(rows):
        key = hashing.mix(key * np.uint64(0xD6E8FEB86659FD93) + bits[:, :, r])
    return key.view(np.int64)


def shingle_sets(words: list[str], k: int) -> Iterator[np.ndarray]:
    for hashes in hashing.word_arrays([t.encode("utf-8", "surrogatepass").lower() for t in words]):
        yield np.unique(hashing.shingles(hashes, k))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    sizes = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))


def signed(docs: DataFrame, k: int, slots: int = SLOTS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the whole set, null if empty) and band keys of every document."""
    import hashlib

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in hashing.slices(whole):
                sets = list(shingle_sets(batch.column("text").to_pylist(), k))
                keys = bands(signatures(sets, slots), rows)
                digests = [hashlib.sha256(s.tobytes()).digest()[:16] if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), _lists([b if len(s) else b[:0] for s, b in zip(sets, keys, strict=True)])],
                    names=["doc_id", "n_shingles", "set_key", "bands"],
                )

    return docs.mapInArrow(sign, "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>")


def parities(shingles: np.ndarray) -> np.ndarray:
    """64 * SKETCH bits: whether an odd number of the set's elements falls on each.

    Two sets differ by as many elements at least as their bits differ.
    """
    odd = np.bincount((shingles % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def sets_of(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, shingles and sketch of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in hashing.slices(whole):
                sets = list(shingle_sets(batch.column("text").to_pylist(), k))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(sets), _lists([parities(s) for s in sets])], names=["doc_id", "shingles", "sketch"])

    return docs.mapInArrow(cut, "doc_id bigint, shingles array<bigint>, sketch array<bigint>")


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80, slots: int = SLOTS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets; component_id is the
    smallest doc_id reachable. A null, empty or blank text has an empty set and is linked with nothing;
    with fewer words than a shingle has, the whole sequence is the only one. Letters A-Z count as a-z.
    Repeated rows with one doc_id are one document and get a row each; a null doc_id is linked with nothing
    (component_id null, kept true). Other columns are ignored; no rows give no rows.
    """
    if percent < 50:
        raise ValueError("bands are laid out for similarities of a half and more")
    docs = texts(docs)
    marks = written(signed(docs, words, slots, rows), "signed")
    sized = marks.where("set_key is not null and doc_id is not null")
    # Equal sets are one node, their smallest document: copies are never compared.
    classes = written(sized.groupBy("set_key").agg(F.min("doc_id").alias("node")), "classes")
    nodes = sized.join(classes, "set_key").where("doc_id = node").dropDuplicates(["node"]).select("node", F.col("n_shingles").alias("n"), "bands")
    spread = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    several = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("bucket")
    members = written(spread.join(several, "bucket"), "buckets")
    candidates = members.select("node", "n").distinct()
    sets = written(sets_of(docs.join(candidates.select(F.col("node").alias("doc_id")), "doc_id", "left_semi"), words).dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "node"), "sets")
    # A shingle that no other candidate has cannot be shared: with many of them a document has no link.
    lone = sets.select("node", F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("rows"), F.min("node").alias("node")).where("rows = 1").groupBy("node").agg(F.count(F.lit(1)).alias("lone"))
    shared = sets.join(lone, "node", "left").select("node", (F.size("shingles") - F.coalesce("lone", F.lit(0))).alias("shared"), "sketch")
    members = written(members.join(shared, "node").where(100 * F.col("shared") >= percent * F.col("n")).select("bucket", "node", "n", "shared", "sketch"), "members")

    def enough(common: Column, n: Column, m: Column) -> Column:
        return common * (100 + percent) >= percent * (n + m)

    def possible(x, y) -> Column:
        apart = [F.bit_count(x("sketch")[k].bitwiseXOR(y("sketch")[k])) for k in range(SKETCH)]
        # Sets of n and m elements with d in only one of them have (n + m - d) / 2 in common.
        return enough(F.least(x("shared"), y("shared")), x("n"), y("n")) & enough((x("n") + y("n") - sum(apart[1:], apart[0])) / 2, x("n"), y("n"))

    def confirm(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("p"))
        two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("q"))
        both = pairs.join(one, "a").join(two, "b")
        return both.where(enough(F.size(F.array_intersect("p", "q")), F.size("p"), F.size("q"))).select("a", "b")

    groups = graph.linked(members, 1 - F.col("shared") / F.col("n"), possible, confirm)
    found = classes.join(groups, "node", "left").select("set_key", F.coalesce("component", "node").alias("component_id"))
    out = marks.join(found, "set_key", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share four fifths of their 4-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=4)
