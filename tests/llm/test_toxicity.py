from __future__ import annotations

import zlib

import pyarrow.parquet as pq
import pytest
from agrolume.llm.common import table
from agrolume.llm.toxicity import Model, fit, fold, hits, op6_toxicity, score

MODEL = Model({"idiot": 3.0, "idi": 1.0, "clown": 2.0}, ("clown fish", "idiot proof"), (-3.0, 2.0, 1.0))


def found(text):
    return sorted(hits(MODEL.automaton(), f" {' '.join(fold(text))} ").values())


@pytest.mark.parametrize(("text", "expected"), [
    ("You IDIOT!!", [(3.0, 6)]),
    ("an іdіоt and an 1d10t", [(3.0, 6), (3.0, 6)]),  # look-alike letters, digits for letters
    ("idiots, idioms", [(1.0, 4), (3.0, 6)]),
    ("midiot 10101 2024", []),  # not at the start of a word; numbers stay numbers
    ("a clown fish | a clown", [(2.0, 6)]),
    ("idiot-proof", []),
    ("", []),
])
def test_matching(text, expected):
    assert found(text) == expected


def test_scores_and_odd_rows(spark, docs_of):
    df = docs_of(["idiot", "idiot " + "word " * 400, "", None, "fine", "fine"], [1, 2, 3, 4, 5, None])
    got = {r.doc_id: (r.score, r.hits) for r in score(df, MODEL).collect()}
    assert got[1][0] > got[2][0] > got[3][0] == got[4][0] == got[5][0] == got[None][0]
    assert got[2][1] == 1 and all(0 <= s <= 1 for s, _ in got.values())
    assert score(df.where("false"), MODEL).count() == 0


def test_fit_without_a_class(spark, docs_of):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id bigint, toxic int")
    model = fit(docs_of(["a", "b", "c"]), labels)
    assert not model.weights and all(r.score < 0.5 for r in score(docs_of(["x"]), model).collect())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = op6_toxicity(spark, sf).collect()
    assert len(rows) == table(spark, sf, "documents").count()
    labels = pq.read_table(f"{sf}/labels.parquet").to_pydict()
    truth = dict(zip(labels["doc_id"], labels["toxic"], strict=True))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in held) / len(held) > 0.93
    assert sum(p for p, t in held if t == 0) <= 1
