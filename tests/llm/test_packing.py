from __future__ import annotations

import collections
import zlib

import numpy as np
import pyarrow.parquet as pq
from agrolume.llm import tokens
from agrolume.llm.packing import op2_packing, pack

SF = "/root/testdata/sf0.001"


def whole(texts):
    t = tokens.encoder(tokens.vocabulary()).tokenizer
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def check(rows, expected, length):
    """rows: (doc, start, ids, total, sequence, offset)."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for doc, start, ids, total, sequence, offset in rows:
        by_doc[doc].append((start, ids, total))
        by_sequence[sequence].append((offset, len(ids)))
    assert set(by_doc) == set(expected)
    for doc, pieces in by_doc.items():
        got = []
        for start, ids, total in sorted(pieces):
            assert start == len(got) and total == len(expected[doc])
            got += ids
        assert got == expected[doc]
    used = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length
        used += at
    return used / (length * len(by_sequence))


def test_encoder_equals_whole_texts():
    e = tokens.encoder(tokens.vocabulary())
    hard = ["A<|endoftext|>b", "<|STARTOFTEXT|> x", "it's I'LL", "É ŒUVRE İstanbul ΣΑΣ", "a\tb\x0bc\x1cd 日本語 ½ ² é ́x", "Ñ,. x.,y a1 \r\n x", "µm ªb ßss ÿ ÷ ×", "", " \n "]
    real = pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()
    for text in hard + real:
        assert np.frombuffer(e.encode(text), "<u2").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_rebuild_documents(spark, docs_of):
    texts = ["alpha beta " * 40, None, "", "one", "long text, " * 900, "one", "a b c " * 100] + ["word " * (k % 37) for k in range(150)]
    rows = [tuple(r) for r in pack(docs_of(texts), length=64, open_windows=4, worth=4, together=2).select("doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset").collect()]
    full = check(rows, dict(enumerate(whole(texts))), 64)
    assert full > 0.9
    assert pack(docs_of([]).where("false")).count() == 0


def test_repeated_and_null_ids(spark, docs_of):
    rows = pack(docs_of(["a b", "a b", "c"], [5, 5, None]), length=16).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, tuple(r.ids)) for r in rows) == sorted([(False, 5, tuple(whole(["a b"])[0]))] * 2 + [(True, 0, tuple(whole(["c"])[0]))])


def test_query_against_whole_table(spark):
    rows = op2_packing(spark, SF).collect()
    docs = pq.read_table(f"{SF}/documents.parquet")
    expected = dict(zip(docs["doc_id"].to_pylist(), whole(docs["text"].to_pylist()), strict=True))
    for r in rows:
        ids = expected[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(np.asarray(ids, "<u4").tobytes()) == r.ids_crc32
    full = check([(r.doc_id, r.start, expected[r.doc_id][r.start : r.start + r.length], r.doc_tokens, r.sequence_id, r.offset) for r in rows], expected, 2048)
    assert full > 0.97


def test_checksums_come_with_the_pieces_and_no_step_reads_the_ids_again(spark, tmp_path):
    import zlib

    import numpy as np

    from agrolume.llm import packing

    rows = [(i, f"some words {i} of a text " * (1 + 37 * i % 900)) for i in range(60)] + [(None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    shown = packing.op2_packing(spark, str(tmp_path))
    assert "ArrowEvalPython" not in shown._jdf.queryExecution().executedPlan().toString()
    pieces = packing.pack(spark.read.parquet(f"{tmp_path}/documents.parquet"), length=100).collect()
    assert {r.doc_id for r in pieces} == {r[0] for r in rows}
    assert all(r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in pieces)
