from __future__ import annotations

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from agrolume.llm.decontaminate import EDITS, LEAST, Q, Index, align, leaks, op3_decontamination, plain, without_leaks

SF = "/root/testdata/sf0.001"


def distance_within(item, doc):
    """Fewest edits from item to any part of doc, cell by cell."""
    row = [0] * (len(doc) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, d in enumerate(doc):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def damaged(draw, text, n):
    chars = list(text)
    for _ in range(n):
        k = draw.randrange(len(chars))
        draw.choice([lambda: chars.insert(k, "z"), lambda: chars.pop(k), lambda: chars.__setitem__(k, "q")])()
    return "".join(chars)


def sentence(draw, n):
    return " ".join("".join(draw.choices("abcdefghij", k=draw.randrange(2, 8))) for _ in range(n))


def test_banded_alignment_is_the_edit_distance():
    draw = random.Random(4)
    for _ in range(60):
        item = sentence(draw, 6)
        doc = sentence(draw, draw.randrange(3)) + damaged(draw, item, draw.randrange(5)) + sentence(draw, draw.randrange(3))
        a, b = plain(item)[0], plain(doc)[0]
        edits, end = align(a, b, 6)
        want = distance_within(a.tolist(), b.tolist())
        assert edits == want or edits > want > 6
        assert distance_within(a.tolist(), b[:end].tolist()) == edits or edits > 6


def bounded(text, k, n):
    """Whether n letters and digits from the k-th on begin with a word and end with one."""
    at = plain(text)[1].tolist()
    before, behind = text[at[k] - 1 : at[k]] if at[k] else "", text[at[k + n - 1] + 1 : at[k + n - 1] + 2]
    return not (before.isalnum() or behind.isalnum())


def brute(passages, text):
    doc = plain(text)[0].tolist()
    found = set()
    for i, t in passages:
        item = plain(t)[0].tolist()
        if 0 < len(item) < max(LEAST, Q + 1):
            if any(doc[k : k + len(item)] == item and bounded(text, k, len(item)) for k in range(len(doc))):
                found.add(i)
        elif item and distance_within(item, doc) <= min(int(EDITS * len(item)), (len(item) - Q) // Q):
            found.add(i)
    return found


def test_all_edited_passages_are_found():
    draw = random.Random(9)
    passages = [(i, sentence(draw, draw.randrange(1, 30))) for i in range(25)] + [(98, ""), (99, "short")]
    index = Index.of(passages, Q, EDITS, LEAST)
    for k in range(60):
        i, t = passages[draw.randrange(25)]
        text = f"{sentence(draw, draw.randrange(15))} {damaged(draw, t, draw.randrange(1 + len(t) // 8))} {sentence(draw, draw.randrange(15))}"
        if k % 3 == 0:
            text = text.upper().replace(" ", "!! | ")
        got = index.find(text)
        assert {g[0] for g in got} == brute(passages, text)
        for item, start, end, edits in got:
            assert distance_within(plain(dict(passages)[item])[0].tolist(), plain(text[start:end])[0].tolist()) <= edits


def test_short_passages_stand_between_word_bounds():
    index = Index.of([(1, "Ab cd"), (2, "ab-cd!"), (3, "x"), (4, "..."), (5, "sentence 42")], Q, EDITS, LEAST)
    assert index.find("ABCD, ab cd") == [(1, 0, 4, 0), (1, 6, 11, 0), (2, 0, 4, 0), (2, 6, 11, 0)]
    assert index.find("xab cd ab cde") == [] and index.find("") == [] and index.find("?") == []
    assert index.find("(x)") == [(3, 1, 2, 0)] and index.find("a sentence 42.") == [(5, 2, 13, 0)] and index.find("a sentence 421") == []
    assert Index.of([(4, "...")], Q, EDITS, LEAST) is None


def test_odd_rows_and_several_indexes(spark, docs_of):
    draw = random.Random(1)
    passages = [sentence(draw, 12) for _ in range(9)]
    benchmark = spark.createDataFrame([*enumerate(passages), (None, "no id"), (50, None)], "item_id bigint, text string")
    texts = [None, "", "clean", passages[3] + " " + passages[3], sentence(draw, 2000) + passages[5] + sentence(draw, 3), passages[7], passages[7]]
    df = docs_of(texts, [0, 1, 2, 3, 4, 5, None])
    for size in (100, 10**6):
        rows = leaks(df, benchmark, index_chars=size).collect()
        assert sorted((r.doc_id or -1, r.item_id) for r in rows) == [(-1, 7), (3, 3), (3, 3), (4, 5), (5, 7)]
        for r in rows:
            assert texts[r.doc_id if r.doc_id is not None else 6][r.start : r.end] == passages[r.item_id] and r.edits == 0
        clean = without_leaks(df, benchmark, index_chars=size)
        assert clean.columns == df.columns and sorted(r.doc_id for r in clean.collect()) == [0, 1, 2]
    nothing = benchmark.where("false")
    assert leaks(df, nothing).count() == 0 and without_leaks(df, nothing).count() == 7
    assert leaks(df.where("false"), benchmark).count() == 0


def test_query_finds_every_verbatim_passage(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    key = lambda t: plain(t)[0].tobytes()
    held = {i: key(t) for i, t in zip(items["item_id"], items["text"], strict=True) if len(plain(t)[0]) >= LEAST}
    want = {(d, i) for d, t in zip(docs["doc_id"], docs["text"], strict=True) for i, k in held.items() if k in key(t)}
    got = {(r.doc_id, r.item_id): r.edits for r in op3_decontamination(spark, SF).collect()}
    assert want and {p for p, e in got.items() if e == 0} == want


@pytest.mark.parametrize("text", ["Éa 𝔸b", "İx", "", "\ud800a"])
def test_places_point_into_the_text(text):
    chars, at = plain(text)
    assert len(chars) == len(at) and all(text[k].isalnum() for k in at.tolist()) and chars.dtype == np.uint32
