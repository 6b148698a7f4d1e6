from __future__ import annotations

import random
import re

import numpy as np
import pyarrow.parquet as pq
from agrolume.llm import graph
from agrolume.llm.neardup import near_duplicates, op7_near_duplicates, signatures


def brute(rows, k, percent=80):
    sets = {}
    for doc, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall("[^\\x20\\x09-\\x0D]+", lower)
        sets[doc] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    where = {}
    for d in ids:
        for s in sets[d]:
            where.setdefault(s, []).append(d)
    for d in ids:
        counts = {}
        for s in sets[d]:
            for e in where[s]:
                if e < d:
                    counts[e] = counts.get(e, 0) + 1
        for e, n in counts.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def results(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_edits_chains_and_odd_texts(spark, docs_of):
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [draw.choice(vocabulary) for _ in range(120)]
    texts = ["", None, " \t\n", "one", "One", "one two", "two one", "a\x85b c\x1cd", "a\x85b C\x1cd"]
    chain = list(base)
    for _ in range(25):  # each step close to the last, the ends far apart
        chain = list(chain)
        chain[draw.randrange(120)] = draw.choice(vocabulary)
        texts.append(" ".join(chain))
    for _ in range(60):  # a group of near copies of one base, most of them not close to each other
        copy = list(base)
        for _ in range(draw.randrange(9)):
            copy[draw.randrange(120)] = draw.choice(vocabulary)
        texts.append("  ".join(copy).upper())
    texts += [" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(1, 60))) for _ in range(60)] + texts[12:20]
    order = list(range(len(texts)))
    draw.shuffle(order)
    rows = list(zip(order, texts, strict=True))
    df = docs_of(texts, order)
    assert results(near_duplicates(df, words=4)) == brute(rows, 4)
    assert near_duplicates(df.where("false")).count() == 0


def test_repeated_rows_and_null_ids(spark, docs_of):
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in near_duplicates(docs_of(["a b c"] * 4, [7, 7, 9, None])).collect())
    assert got == [(-1, -1, True), (7, 7, True), (7, 7, True), (9, 7, False)]


def test_signature_estimates_similarity():
    draw = np.random.default_rng(3)
    a = draw.integers(1, 2**63, 400, dtype=np.uint64)
    sets = [a, np.concatenate((a[:360], draw.integers(1, 2**63, 40, dtype=np.uint64))), a[:3], np.empty(0, np.uint64)]
    s = signatures(sets)
    assert abs((s[0] == s[1]).mean() - 360 / 440) < 0.12
    assert np.isinf(s[3]).all() and np.isfinite(s[:3]).all()
    # Element by element the signature is the same minimum.
    assert (np.minimum.reduce(signatures([a[i : i + 1] for i in range(3)])) == s[2]).all()


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 90), (90, 100), (5, 5)], "a bigint, b bigint")
    got = {r.node: r.component for r in graph.components(edges).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {90: 90, 100: 90}


def test_query_against_brute_force(spark):
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    rows = list(zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist(), strict=True))
    assert results(op7_near_duplicates(spark, "/root/testdata/sf0.001")) == brute(rows, 4)
