from __future__ import annotations

import math
import random
import re

import pytest
from agrolume.llm import ranked as module
from agrolume.llm.ranked import ranked

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, top=10):
    """docs, items: (id, text); rows of one item are one."""
    held = [(d, t) for d, t in ((d, terms(x)) for d, x in docs) if d is not None and t]
    if not held:
        return []
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    asked = {}
    for i, x in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(x))
    out = []
    for i, words in asked.items():
        scored = []
        for d, t in held:
            m = 10 + 90 * len(t) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * t.count(x) // (1000 * t.count(x) + 8 * m)) for x in words if x in t)
            if score > 0:
                scored.append((-score, d))
        out += [(i, k + 1, d, -s) for k, (s, d) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def corpus(seed, n):
    draw = random.Random(seed)
    words = [f"W{i}" if i % 3 else f"é{i}日" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    return [" ".join(draw.choices(words, weights, k=draw.randrange(0, 60))) for _ in range(n)]


def rows(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, docs_of, monkeypatch, small):
    if small:  # many blocks, long texts in pieces, several passes
        for name, value in (("BLOCK_DOCS", 7), ("BLOCK_POSTINGS", 40), ("PIECE", 5)):
            monkeypatch.setattr(module, name, value)
    texts = [None, "", "...", *corpus(1, 300)]
    texts += texts[10:20] * 3 + ["w1 " * 5000 + "W2-w2/w3"]
    items = [(i, t) for i, t in enumerate(corpus(2, 15))] + [(3, "w1 and Straße"), (99, None), (98, "?!"), (None, "w1"), (97, "nowhere")]
    asked = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as rank", "'x' as n")
    got = rows(ranked(docs_of(texts), asked, pass_bytes=200 if small else 4_000_000))
    assert got == brute(list(enumerate(texts)), items)
    assert {r[1] for r in got} == set(range(1, 11))


def test_ties_repeats_and_nulls(spark, docs_of):
    docs = docs_of(["aa bb", "aa bb", "aa cc", "AA-bb", "dd"], ids=[7, 7, 2, 5, None])
    items = spark.createDataFrame([(1, "bb aa"), (1, "aa")], "item_id bigint, text string")
    got = rows(ranked(docs, items))
    assert [(r[1], r[2]) for r in got] == [(1, 5), (2, 7), (3, 7)] + [(4, 2)] * (len(got) - 3)
    assert ranked(docs.where("false"), items).count() == 0 and ranked(docs, items.where("false")).count() == 0


def test_accumulators_stop_early():
    """After a rare term's documents are ahead for good, a common term makes no new accumulator but still adds to theirs."""
    import numpy as np

    n = 1000
    sizes, counts = np.full(n, 10), np.ones(n, np.int64)
    counts[:3] = 2
    ids = np.concatenate([np.tile([0, 1], 3), np.ones(n - 3, np.int64)]).astype(np.int32)
    request = module.Request([(1, np.array([0, 1]))], np.array([5000, 3]), n, 10 * n, 3)
    block = module.Block(request, np.arange(n), sizes, counts, ids, np.ones(len(ids), np.int64))
    made = []
    block.created = type("Seen", (np.ndarray,), {"__setitem__": lambda self, k, v: (made.append(k) if v is True else None, np.ndarray.__setitem__(self, k, v))[1]})(n, bool)
    np.ndarray.fill(block.created, False)
    scores, docs = block.search(np.array([0, 1]), 3, 0)
    assert docs.tolist() == [0, 1, 2] and sum(len(k) for k in made) == 3
    assert scores[0] == block.most[0] + block.most[1]


def test_pieces_cut_no_term():
    text = "Ab1 é\x00c".encode() * 50
    module_piece = module.PIECE
    try:
        module.PIECE = 3
        got = [t for p in module._pieces(text) for t in p]
    finally:
        module.PIECE = module_piece
    assert got == [t.encode() for t in terms(text.decode())]
