"""Every token of every training text trains the model once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from agrolume.llm import attention as A
from agrolume.llm import lm

TEXTS = [np.random.default_rng(n).integers(0, 3000, n).astype("<u2") for n in (0, 1, 15, 16, 17, 200, 5000)]


def with_end(x):
    return np.append(x, lm.LAST).astype(np.int64)


def test_windows_hold_each_token_once_with_the_one_before():
    for x in map(with_end, TEXTS):
        raw = A.training_windows(x)
        known = raw[:, -1:].astype(int) >> np.arange(A.WINDOW) & 1 == 1
        assert raw[:, 1:-1][known].tolist() == x.tolist()
        before = [A.NONE, *x[A.WINDOW - 1 : -1 : A.WINDOW]]
        assert raw[:, 0].tolist() == before[: len(raw)]


@pytest.mark.parametrize("block", [1, 7, 65_536])
def test_rounds_take_every_window_once(monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK", block)
    batches = [pa.RecordBatch.from_pydict({"ids": [x.tobytes() for x in TEXTS[a : a + 3]]}) for a in (0, 3, 6)]
    got = [w.tobytes() for turn in range(lm.ROUNDS) for part in lm.blocks(iter(batches), turn) for w in part]
    want = [w.tobytes() for x in TEXTS for w in A.training_windows(with_end(x))]
    assert sorted(got) == sorted(want)


def test_held_out_score_beats_the_base(spark):
    rows = lm.op5_language_model(spark, "/root/testdata/sf0.1").where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert rows["sum(score)"] > 0.98 * rows["sum(base_score)"], rows
