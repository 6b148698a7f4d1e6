from __future__ import annotations

import hashlib
import itertools
import random

import pyarrow.parquet as pq
from agrolume.llm.fingerprints import edited, fingerprint_all, op10_fingerprints, within


def expected(rows):
    """rows: (doc_id, text) with distinct ids."""
    rows = sorted((d, t or "") for d, t in rows)
    out = {}
    for (doc, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        out[doc] = (len(text), text[: len(text) - half] + following[:half], following)
    return out


def check(got, rows):
    want = expected(rows)
    assert sorted(r.doc_id for r in got) == sorted(want)
    for r in got:
        n, changed, following = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(changed.encode()).hexdigest())
        text = dict(rows)[r.doc_id] or ""
        prints = [p.hex() for p in fingerprint_all([text, changed, following])]
        assert [r.fingerprint, r.edited_fingerprint] == prints[:2]
        alike = [1 - (int(prints[0], 16) ^ int(p, 16)).bit_count() / 128 for p in prints[1:]]
        assert [r.near_edited, r.near_next] == alike


def test_edited_texts(spark, docs_of):
    draw = random.Random(2)
    texts = [None, "", "é", "ab", "日本語", "one two three four"] + [" ".join(draw.choices("abcdefgh", k=draw.randrange(80))) for _ in range(120)]
    ids = draw.sample(range(-500, 10**12, 7), len(texts) - 30) + list(range(30))
    df = docs_of(texts, ids)
    for parts in (2, 7, 200):
        check(edited(df, parts=parts).collect(), list(zip(ids, texts, strict=True)))


def test_few_repeated_and_null_ids(spark, docs_of):
    check(edited(docs_of(["only one"], [4])).collect(), [(4, "only one")])
    assert edited(docs_of(["x"]).where("false")).count() == 0
    rows = edited(docs_of(["aaaa", "bbbb", "bbbb", "cccc", "null id"], [1, 2, 2, 3, None]), parts=3).collect()
    shas = sorted((r.doc_id or 0, r.edited_sha256) for r in rows)
    assert shas == sorted((d, hashlib.sha256(t.encode()).hexdigest()) for d, t in [(1, "aabb"), (2, "bbbb"), (2, "bbcc"), (3, "ccaa"), (0, "null id"[:4] + "nul")])


def test_search_finds_all_within_the_radius(spark):
    draw = random.Random(8)
    base = [draw.getrandbits(128) for _ in range(40)]
    prints = {b for b in base}
    for b in base:
        for n in range(1, 7):
            prints.add(b ^ sum(1 << k for k in draw.sample(range(128), n)))
    prints = sorted(prints)
    hexes = [f"{p:032x}" for p in prints]
    corpus = spark.createDataFrame([(h,) for h in [*hexes, None]], "fingerprint string")
    asked = spark.createDataFrame([(h,) for h in hexes[::3]], "fingerprint string")
    for radius in (0, 3, 5):
        got = {(r["query"], r.fingerprint, r.distance) for r in within(asked, corpus, radius=radius).collect()}
        want = {(f"{a:032x}", f"{b:032x}", (a ^ b).bit_count()) for a, b in itertools.product(prints[::3], prints) if (a ^ b).bit_count() <= radius}
        assert got == want


def test_query_against_whole_table(spark):
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    rows = op10_fingerprints(spark, "/root/testdata/sf0.001").collect()
    check(rows, list(zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist(), strict=True)))
    prints = [int(r.fingerprint, 16) for r in rows]
    for r in rows:
        near = sum((int(r.fingerprint, 16) ^ p).bit_count() <= 3 for p in prints)
        assert r.n_near == (near if r.doc_id % 100 == 0 else None)
    far = sorted(r.near_edited - r.near_next for r in rows if r.n_chars > 200)
    assert far[len(far) // 20] > 0  # nearer to its edited text than to its neighbour
