from __future__ import annotations

import corpus_pipeline as P
import pyarrow.parquet as pq
import pytest
from test_decontaminate import plain
from test_lines import brute as brute_lines
from test_neardup import brute as brute_groups
from test_packing import check, whole

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in P.STAGES:
        out.append(stage(spark, out[-1], SF).persist())
    yield out
    for df in out[1:]:
        df.unpersist()


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "near-dedup", "decontamination", "packing"]


def test_toxic_documents_go(stages):
    labels = pq.read_table(f"{SF}/labels.parquet").to_pydict()
    truth = dict(zip(labels["doc_id"], labels["toxic"], strict=True))
    before, after = rows(stages[0]), rows(stages[1])
    gone = before.keys() - after.keys()
    clean = [d for d in before if truth.get(d) == 0]
    assert gone and sum(d in gone for d in clean) <= 0.01 * len(clean)
    assert all(before[d] == t for d, t in after.items())


def test_lines(stages):
    before, after = rows(stages[1]), rows(stages[2])
    want = brute_lines(list(before.items()))
    assert after == {d: t for d, t in want.items() if t == before[d] or t.strip()}
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_groups(stages):
    before, after = rows(stages[2]), rows(stages[3])
    assert after == {d: before[d] for d, (_, _, kept) in brute_groups(list(before.items()), 5).items() if kept}


def test_leaks(stages):
    items = [plain(t)[0].tobytes() for t in pq.read_table(f"{SF}/benchmark.parquet")["text"].to_pylist()]
    before, after = rows(stages[3]), rows(stages[4])
    leaky = {d for d, t in before.items() if any(len(i) >= 96 and i in plain(t)[0].tobytes() for i in items)}
    assert leaky <= before.keys() - after.keys()
    # Nothing else goes that does not hold half a passage word for word.
    for d in before.keys() - after.keys() - leaky:
        assert any(i[: len(i) // 8 * 4] in plain(before[d])[0].tobytes() or i[len(i) // 8 * 4 :] in plain(before[d])[0].tobytes() for i in items)


def test_packed(stages):
    before = rows(stages[4])
    expected = dict(zip(before, whole(before.values()), strict=True))
    check([(r.doc_id, r.start, r.ids, r.doc_tokens, r.sequence_id, r.offset) for r in stages[5].collect()], expected, 2048)


def test_run_is_the_stages(spark, stages):
    assert P.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").distinct().count() > 0
    assert {r.doc_id for r in P.run(spark, SF).collect()} == set(rows(stages[4]))


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, 7), (2, "", "en", "s", 0, 7), (None, "no id", None, None, 5, 7), (3, "one two three four five six", "en", "s", 27, 7), (3, "one two three four five six", "en", "s", 27, 7), (4, "one two three four five six", None, None, 27, 7)], "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id int")
    left = docs
    for _, stage in P.STAGES[:-1]:
        left = stage(spark, left, SF)
        assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, "no id"), (1, ""), (2, ""), (3, "one two three four five six"), (3, "one two three four five six")]
    empty = docs.where("false")
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0
