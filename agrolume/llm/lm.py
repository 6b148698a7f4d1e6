"""Language-model scores of whole texts: a unigram base and a causal self-attention model.

Everything learned comes from the training texts: word counts and token counts of all
their words and tokens, how often frequent tokens follow each other, and gradients at
every token of each text. Partitions train apart from common parameters, on windows they
cut from their own ids, and the results are averaged, once a round; what the corpus sends
grows with it, what the driver holds depends on the vocabulary alone.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.llm import attention, tokens
from agrolume.llm.common import is_true, ship, table, written

#: Times that partitions train and are averaged. A round takes every ROUNDS-th window of each text; together they take every window once, at every size of the corpus.
ROUNDS = 2
#: Step of the first round; it falls within a round, and from round to round.
RATE = 0.03
#: Windows that a task holds, shuffles and trains on at a time.
BLOCK = 65_536
#: Models that a round averages at most; beyond, a task trains on more of the corpus.
MODELS = 4096
#: A word with a share of at least this of all tokens is looked up where its text is read: there are 1 / SHARE of them at most.
SHARE = 1e-5
#: Words counted by a task before it passes counts on.
HELD = 200_000
IDS = 49_408
LAST = 49_407
END = b""


def _words(text: str) -> list[bytes]:
    """Runs without ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def keyed(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, text, held_out and two hashes of the text, which stand for it where scores are joined."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), is_true(held_out).alias("held_out"))
    return rows.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64("text", F.lit(1))})


def read_once(rows: DataFrame, path: str) -> DataFrame:
    """What one reading of the texts gives: their ids, and partial counts of the training words (END: one a text)."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("train", pa.bool_()), ("ids", pa.binary()), ("word", pa.binary()), ("n", pa.int64())])

    def counted(seen: Counter) -> pa.RecordBatch:
        none = [None] * len(seen)
        return pa.RecordBatch.from_pydict({"k1": none, "k2": none, "train": none, "ids": none, "word": list(seen), "n": list(seen.values())}, schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path).encode
        seen: Counter = Counter()
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                batch = whole.slice(a, 1000)
                ids = []
                for text, held in zip(batch.column("text"), batch.column("held_out").to_pylist(), strict=True):
                    text = text.as_py()
                    ids.append(encode(text))
                    if not held:
                        seen.update(_words(text))
                        seen[END] += 1
                    if len(seen) > HELD:
                        yield counted(seen)
                        seen = Counter()
                n = batch.num_rows
                train = pa.array([not h for h in batch.column("held_out").to_pylist()], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), train, pa.array(ids, pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())], schema=schema)
        if seen:
            yield counted(seen)

    return rows.mapInArrow(read, "k1 bigint, k2 bigint, train boolean, ids binary, word binary, n bigint")


def _counts(held: DataFrame) -> np.ndarray:
    """How often each token id occurs in the training texts: as many rows as the vocabulary has at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(IDS, np.int64)
        for batch in batches:
            for x in batch.column("ids"):
                total += np.bincount(np.frombuffer(x.as_py(), "<u2"), minlength=IDS)
                total[LAST] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])

    out = np.zeros(IDS)
    for r in held.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r.id] = r.n
    return out


def _follows(held: DataFrame, rank: np.ndarray) -> np.ndarray:
    """How often a class of tokens follows another: the square of the number of classes at most."""
    size = attention.OWN + attention.CLUSTERS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                ids = np.concatenate([np.append(np.frombuffer(x.as_py(), "<u2"), LAST) for x in batch.column("ids").slice(a, 500)])
                r = rank[ids]
                inside = ids[:-1] != LAST
                total += np.bincount(r[:-1][inside] * size + r[1:][inside], minlength=size * size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at // size, pa.int64()), pa.array(at % size, pa.int64()), pa.array(total[at], pa.int64())], names=["i", "j", "n"])

    pairs = held.select("ids").mapInArrow(count, "i bigint, j bigint, n bigint").groupBy("i", "j").agg(F.sum("n").alias("n"))
    rows = pairs.groupBy("i").agg(F.collect_list(F.struct("j", "n")).alias("row"))
    out = np.zeros((size, size))
    for r in rows.collect():
        out[r.i, [x.j for x in r.row]] = [x.n for x in r.row]
    return out


def blocks(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[np.ndarray]:
    """The windows of one round, of all texts of a partition, shuffled in blocks of BLOCK windows."""
    draw = np.random.default_rng(turn)
    kept, size = [], 0
    for batch in batches:
        for x in batch.column("ids"):
            windows = attention.training_windows(np.append(np.frombuffer(x.as_py(), "<u2"), LAST).astype(np.int64))
            # A text of one window takes part in the round that its length says.
            windows = windows[(turn + len(windows)) % ROUNDS :: ROUNDS]
            for a in range(0, len(windows), BLOCK):
                kept.append(windows[a : a + BLOCK])
                size += len(kept[-1])
                if size >= BLOCK:
                    block = np.concatenate(kept)
                    yield block[draw.permutation(len(block))]
                    kept, size = [], 0
    if kept:
        block = np.concatenate(kept)
        yield block[draw.permutation(len(block))]


def trained(held: DataFrame) -> tuple[np.ndarray, attention.Classes]:
    """Parameters and classes learned from the rows of ``held`` (ids of training texts)."""
    counts = _counts(held)
    classes, flat = attention.Classes.of(counts, _follows(held, attention.ranks(counts)))
    sent = held.sparkSession.sparkContext.broadcast(classes)
    ids = held.select("ids").coalesce(MODELS)
    parts = max(1, ids.rdd.getNumPartitions())
    steps = int(counts.sum() / attention.WINDOW / attention.BATCH / ROUNDS / parts)
    for turn in range(ROUNDS if counts.any() else 0):

        def learn(batches: Iterator[pa.RecordBatch], flat=flat, turn=turn) -> Iterator[pa.RecordBatch]:
            tokens.forget()
            learner, n = attention.Learner(flat, sent.value, RATE / (1 + turn), steps), 0
            for block in blocks(batches, turn):
                learner.learn(block)
                n += len(block)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([learner.flat.tolist()], pa.list_(pa.float32())), pa.array([n], pa.int64())], names=["flat", "n"])

        models = ids.mapInArrow(learn, "flat array<float>, n bigint").select("n", F.posexplode("flat").alias("i", "x"))
        mean = models.groupBy("i").agg((F.sum(F.col("x").cast("double") * F.col("n")) / F.sum("n")).alias("x")).collect()
        if mean:
            flat = np.array([r.x for r in sorted(mean, key=lambda r: r.i)], np.float32)
    return flat, classes


def attention_scores(held: DataFrame, flat: np.ndarray, classes: attention.Classes) -> DataFrame:
    """k1, k2 and score of each text of ``held``."""
    sent = held.sparkSession.sparkContext.broadcast((flat, classes))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        flat, classes = sent.value
        for whole in batches:
            for a in range(0, whole.num_rows, 100):
                batch = whole.slice(a, 100)
                ids = [np.append(np.frombuffer(x.as_py(), "<u2"), LAST).astype(np.int64) for x in batch.column("ids")]
                yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), pa.array(attention.log10_probability(flat, classes, ids), pa.float64())], names=["k1", "k2", "score"])

    return held.select("k1", "k2", "ids").mapInArrow(mark, "k1 bigint, k2 bigint, score double")


def base_scores(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_id, k1, k2, held_out, n_tokens, n_known, train_tokens and base_score of each row of ``rows``."""
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    all_tokens, kinds = total.n or 0, total.v
    # At most 1 / SHARE words; no other word is a hot key of the join below.
    frequent = {bytes(r.word): math.log10(r.n + 0.1) for r in counts.where(F.col("n") >= SHARE * all_tokens).collect()} if all_tokens else {}
    sent = rows.sparkSession.sparkContext.broadcast(frequent)
    schema = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("logs", pa.float64()), ("word", pa.list_(pa.binary())), ("times", pa.list_(pa.int64()))])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        frequent = sent.value
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                batch = whole.slice(a, 1000)
                sizes, known, logs, rare, times = [], [], [], [], []
                for text in batch.column("text"):
                    words = _words(text.as_py())
                    seen = Counter(words)
                    seen[END] = 1
                    here = seen.keys() & frequent.keys()
                    known.append(sum(seen[w] for w in here))
                    logs.append(math.fsum(seen[w] * frequent[w] for w in here))
                    sizes.append(len(words) + 1)
                    left = seen.keys() - here
                    rare.append(list(left))
                    times.append([seen[w] for w in left])
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "k1", "k2", "held_out")], *[pa.array(v, schema.field(i + 4).type) for i, v in enumerate((sizes, known, logs, rare, times))]], schema=schema)

    parts = rows.mapInArrow(split, "doc_id bigint, k1 bigint, k2 bigint, held_out boolean, n_tokens bigint, known bigint, logs double, word array<binary>, times array<bigint>")
    parts = written(parts.withColumn("row", F.monotonically_increasing_id()), "words")
    rare = parts.select("row", F.explode(F.arrays_zip("word", "times")).alias("x")).select("row", "x.word", "x.times").join(counts.where(F.col("n") < SHARE * all_tokens), "word")
    rare = rare.groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 0.1)).alias("more_logs"))
    known = F.col("known") + F.coalesce("more", F.lit(0))
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + (F.col("n_tokens") - known) * math.log10(0.1)
    return parts.drop("word", "times").join(rare, "row", "left").select(
        "doc_id", "k1", "k2", "held_out", "n_tokens", known.alias("n_known"), F.lit(all_tokens).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * math.log10(all_tokens + 0.1 * (kinds + 1))).alias("base_score"),
    )


def language_scores(docs: DataFrame, held_out: Column, path: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Learns from the rows where ``held_out`` is not true. A null or empty text is its end alone. Repeated rows count
    and are scored each, a null doc_id stays null, other columns are ignored. Without training rows all words are
    unknown and the model keeps the parameters it begins with; no rows give no rows.
    """
    path = path or tokens.vocabulary()
    rows = keyed(docs, held_out)
    once = written(read_once(rows, path), "read")
    counts = written(once.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    held = once.where("ids is not null")
    flat, classes = trained(held.where("train"))
    scores = attention_scores(held, flat, classes).dropDuplicates(["k1", "k2"])
    return base_scores(rows, counts).join(scores, ["k1", "k2"]).drop("k1", "k2")


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and attention scores of all documents, learned from nine tenths of them."""
    return language_scores(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 10 == 0)
