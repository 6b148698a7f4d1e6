from __future__ import annotations

import math
import random

import numpy as np
import pytest
from agrolume.llm import annuli as module
from agrolume.llm.annuli import Search, Shape, build, integer_vectors, top_k


def brute(vectors, every=50, top=5):
    held = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    held = [list(x) for x in {(i, tuple(v)) for i, v in held}]
    out = []
    for q in held:
        if q[0] % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q[1], v[1])), v[0]) for v in held if v is not q)
            out += [(q[0], k + 1, i, -s) for k, (s, i) in enumerate(scored[:top])]
    return sorted(out)


def vectors(seed, n, width, clusters=8):
    draw = random.Random(seed)
    means = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(clusters)]
    return [(i, [float(np.float32(m + draw.gauss(0, 0.2))) for m in draw.choice(means)]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 as v", "'a' as rank", "0 as q").repartition(3)


def rows(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("ANNULUS_ROWS", 7), ("SHELF", 5)):
            monkeypatch.setattr(module, name, value)
    held = vectors(1, 700, 12)
    held += [(i, held[40][1]) for i in range(700, 1000)]  # one vector many times over: ties
    got = rows(top_k(frame(spark, held), every=10, query_bytes=1500 if small else 8_000_000))
    assert got == brute(held, every=10)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    held = [(0, [1.0, -0.5]), (0, [1.0, -0.5]), (0, [0.25, 0.25]), (50, [1.0, -0.5]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [1.0, -inf]), (None, [1.0, 1.0]), (5, []), (6, [-0.001, 0.0]), (-50, [0.0, 2.0]), (7, [1.0])]
    got = rows(top_k(frame(spark, held)))
    padded = [(i, None if v is None else v + [0.0] * (2 - len(v))) for i, v in held]
    assert got == brute(padded)
    assert top_k(frame(spark, held).where("false")).count() == 0
    assert rows(top_k(frame(spark, [(50, [1.0])]))) == []


@pytest.mark.parametrize("scale", [1.0, 1e4, 1e6])
def test_exact_at_every_size(spark, scale):
    held = [(i, [float(np.float32(x * scale)) for x in v]) for i, v in vectors(4, 120, 6)]
    assert rows(top_k(frame(spark, held))) == brute(held)


def test_scores_beyond_64_bits_are_held(spark):
    held = [(i, [1e30, float(i)]) for i in range(9)]
    got = rows(top_k(frame(spark, held)))
    assert len(got) == 5 and all(r[3] == 2**63 - 1 for r in got)


def test_bounds_hold_and_stop_the_search(spark):
    held = vectors(7, 4000, 3, clusters=40)
    index = build(integer_vectors(frame(spark, held)))
    shape = index.shape
    rows_ = index.annuli.collect()
    blocks = [(r.pivot, r.lo, r.hi, r.norm, np.frombuffer(r.ids, "<i8"), np.frombuffer(r.vectors, shape.stored).reshape(-1, shape.width)) for r in rows_]
    assert sum(len(b[4]) for b in blocks) == 4000
    q = np.concatenate([b[5] for b in blocks])[::100]
    search = Search(shape, index.pivots, np.full(len(q), -1), q, np.full(len(q), -(2.0**63)), 5)
    facts = [np.array(x) for x in list(zip(*blocks, strict=True))[:4]]
    bound = search.bounds(*facts)
    for k, b in enumerate(blocks):
        assert (shape.products(q, b[5]).max(1) <= bound[:, k]).all()
    search.expand(*facts, [b[4] for b in blocks], [b[5] for b in blocks])
    assert search.visits < 0.7 * len(q) * len(blocks)
    assert Shape.of(64, 256).kind is np.float64
