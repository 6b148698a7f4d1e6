from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from agrolume.llm import attention as A
from agrolume.llm import tokens
from agrolume.llm.lm import IDS, LAST, language_scores, op5_language_model
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\\x20\\x09-\\x0D]+", low), None]


def base(rows):
    """rows: (doc_id, text, held_out)."""
    counts = Counter()
    for _, t, h in rows:
        if not h:
            counts.update(words(t))
    n, v = sum(counts.values()), len(counts)
    out = {}
    for d, t, _ in rows:
        w = words(t)
        out[d] = (len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w) if n else None)
    return out


@pytest.fixture(scope="module")
def model():
    draw = np.random.default_rng(0)
    counts = np.zeros(49408)
    counts[:3000] = draw.integers(1, 500, 3000)
    size = A.OWN + A.CLUSTERS
    classes, flat = A.Classes.of(counts, draw.poisson(0.05, (size, size)).astype(float))
    return classes, flat


def draw_rows(p):
    draw = np.random.default_rng(5)
    return p, draw.normal(size=(300, A.WIDTH)).astype(np.float32), draw.integers(0, A.CLUSTERS, 300), draw.integers(0, A.PLACES, 300)


def test_probabilities_sum_to_one(model):
    classes, flat = model
    assert len({(c, p) for c, p in zip(classes.cluster, classes.place, strict=True)}) == A.CLUSTERS * A.PLACES
    context = [5, 17, 900]
    every = A.log10_probability(flat, classes, [np.array([*context, k]) for k in range(0, 49408, 1)][:49408:16])
    head = A.log10_probability(flat, classes, [np.array(context)])[0]
    assert (every - head < 0).all()
    whole = np.zeros((A.CLUSTERS, A.PLACES))
    state, _ = A.forward(A.unpacked(flat), A.expanded(A.raw_windows(np.array([*context, 0])), classes)[0])
    for c in range(A.CLUSTERS):
        whole[c] = np.exp(A.log_probability(A.unpacked(flat), np.repeat(state[0, 3:4], A.PLACES, 0), np.full(A.PLACES, c), np.arange(A.PLACES)))
    assert abs(whole.sum() - 1) < 1e-4
    rows = draw_rows(A.unpacked(flat))
    assert np.allclose(A.score_only(*rows), A.log_probability(*rows), atol=1e-4)
    assert np.isclose(np.bincount(classes.cluster * A.PLACES + classes.place, 10**classes.share).sum(), A.CLUSTERS * A.PLACES)


def test_gradient(model):
    classes, flat = model
    draw = np.random.default_rng(1)
    batch = (draw.integers(0, A.INPUTS, (2, A.WINDOW)), draw.integers(0, A.CLUSTERS, (2, A.WINDOW)), draw.integers(0, A.PLACES, (2, A.WINDOW)), draw.random((2, A.WINDOW)) < 0.7)
    flat = flat.astype(np.float64)
    _, g = A.gradient(flat, *batch)
    for k in np.argsort(-np.abs(g))[:400:20]:
        up, down = flat.copy(), flat.copy()
        up[k] += 1e-4
        down[k] -= 1e-4
        assert np.isclose((A.gradient(up, *batch)[0] - A.gradient(down, *batch)[0]) / 2e-4, g[k], rtol=0.02, atol=1e-5)


def test_each_token_is_scored_once_and_only_from_the_past(model):
    classes, flat = model
    draw = np.random.default_rng(2)
    for n in (1, 2, A.WINDOW, A.WINDOW + 1, 3 * A.WINDOW, 100):
        ids = draw.integers(0, 3000, n)
        inputs, cluster, place, known = A.expanded(A.raw_windows(ids), classes)
        assert known.sum() == n
        scored = np.stack((cluster[known], place[known]), 1)
        assert sorted(map(tuple, scored)) == sorted(zip(classes.cluster[ids], classes.place[ids], strict=True))
    # A later token changes no earlier probability; texts scored together are as texts scored apart.
    a, b = draw.integers(0, 3000, 70), draw.integers(0, 3000, 40)
    apart = [A.log10_probability(flat, classes, [x])[0] for x in (a, b)]
    assert np.allclose(A.log10_probability(flat, classes, [a, b]), apart)
    state, _ = A.forward(A.unpacked(flat), A.expanded(A.raw_windows(a), classes)[0])
    changed = a.copy()
    changed[9] = (changed[9] + 1) % 3000
    other, _ = A.forward(A.unpacked(flat), A.expanded(A.raw_windows(changed), classes)[0])
    assert np.allclose(state[0, :10], other[0, :10]) and not np.allclose(state[0, 10], other[0, 10])


def test_odd_rows(spark, docs_of):
    rows = [(1, None, False), (2, "", True), (3, "A b\x0bB", False), (4, "a\x85 b zz", True), (2**62, "a " * 500, False)]
    df = docs_of([t for _, t, _ in rows], [d for d, _, _ in rows])
    got = {r.doc_id: r for r in language_scores(df, F.col("doc_id").isin(2, 4)).collect()}
    for d, want in base(rows).items():
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3] and abs(r.base_score - want[3]) < 1e-6 and r.score < 0
    assert got[1].score == got[2].score
    none = language_scores(df, F.lit(True)).collect()
    assert len(none) == 5 and all(r.train_tokens == 0 and r.n_known == 0 for r in none)
    assert language_scores(df.where("false"), F.lit(False)).count() == 0


def test_query_against_brute_force(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in docs["doc_id"]}
    want = base([(d, t, held[d]) for d, t in zip(docs["doc_id"], docs["text"], strict=True)])
    rows = op5_language_model(spark, SF).collect()
    assert len(rows) == len(want)
    for r in rows:
        n, known, total, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], n, known, total)
        assert math.isclose(r.base_score, score, rel_tol=1e-9)
    # Far better on held-out texts than the shares of the tokens alone.
    encode = tokens.encoder(tokens.vocabulary()).encode
    ids = {d: np.append(np.frombuffer(encode(t or ""), "<u2"), LAST) for d, t in zip(docs["doc_id"], docs["text"], strict=True)}
    counts = sum(np.bincount(x, minlength=IDS) for d, x in ids.items() if not held[d]) + 0.1
    shares = np.log10(counts / counts.sum())
    alone = sum(shares[ids[d]].sum() for d in ids if held[d])
    assert sum(r.score for r in rows if r.held_out) > 0.85 * alone


def test_words_are_let_go():
    """A worker that trains or scores does not hold the words that it kept to read texts."""
    path = tokens.vocabulary()
    before = tokens.encoder(path).encode("one two")
    tokens.forget()
    assert not tokens._encoders
    assert tokens.encoder(path).encode("one two") == before
