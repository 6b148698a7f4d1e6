from __future__ import annotations

import zlib

import numpy as np
import pyarrow.parquet as pq
from agrolume.llm.quality import NAMES, Features, fit, isotonic, measured, op4_quality, quality, scored

SF = "/root/testdata/sf0.01"


def test_isotonic_is_the_least_squares_fit():
    draw = np.random.default_rng(0)
    y, n = draw.random(40), draw.integers(1, 9, 40)
    at, values = isotonic(np.arange(40.0), y * n, n)
    assert (np.diff(values) > 0).all() and (np.diff(at) > 0).all()
    # Blocks between which no split raises the order: every prefix of a block has a mean no smaller.
    sizes = [(np.abs(values - v)).argmin() for v in values]
    assert sizes == list(range(len(values)))
    assert np.isclose(sum(values * [n[(np.arange(40) > a) & (np.arange(40) <= b)].sum() for a, b in zip([-1, *ends(y, n)[:-1]], ends(y, n), strict=True)]), (y * n).sum())


def ends(y, n):
    """Last index of each block, by the greatest convex minorant."""
    at, c, t = [], np.concatenate(([0], np.cumsum(n))), np.concatenate(([0], np.cumsum(y * n)))
    k = 0
    while k < len(y):
        slopes = (t[k + 1 :] - t[k]) / (c[k + 1 :] - c[k])
        k = k + 1 + int(np.flatnonzero(slopes == slopes.min())[-1])
        at.append(k - 1)
    return at


def test_features_approximate_a_gaussian_kernel():
    x = np.random.default_rng(1).normal(size=(40, len(NAMES)))
    z = Features(np.zeros(len(NAMES)), np.ones(len(NAMES)), cosines=4096)(x)[:, 1 + len(NAMES) :]
    apart = ((x[:, None] - x[None]) ** 2).sum(2)
    assert np.abs(z @ z.T - np.exp(-apart / (2 * len(NAMES)))).max() < 0.1


def test_odd_rows(spark, docs_of):
    df = docs_of(["", None, "word", "word", "x " * 5000], [1, 2, 3, None, 2**62 + 1])
    labels = spark.createDataFrame([(1, 0), (3, 1), (None, 0), (2**62 + 1, None)], "doc_id bigint, quality int")
    got = {r.doc_id: r.score for r in quality(df, labels).collect()}
    assert set(got) == {1, 2, 3, None, 2**62 + 1} and got[1] == got[2] and got[3] == got[None]
    assert all(0 <= s <= 1 for s in got.values())
    for rows, want in (([], 0.5), ([(3, 1)], 1.0)):
        assert {r.score for r in quality(df, spark.createDataFrame(rows, "doc_id bigint, quality int")).collect()} == {want}
    assert quality(df.where("false"), labels).count() == 0


def test_partitions_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    x = measured(docs.limit(400)).cache()
    a, b = ({r.doc_id: r.score for r in scored(x, fit(x.repartition(k), labels)).collect()} for k in (1, 6))
    assert max(abs(a[d] - b[d]) for d in a) < 1e-5


def test_held_out_accuracy(spark):
    rows = op4_quality(spark, SF).collect()
    labels = pq.read_table(f"{SF}/labels.parquet").to_pydict()
    truth = dict(zip(labels["doc_id"], labels["quality"], strict=True))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r.predicted == truth[r.doc_id] for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and sum(held) / len(held) > 0.97
