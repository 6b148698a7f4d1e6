from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from agrolume.llm import trie as module
from agrolume.llm.trie import positions, prefix_trie, rebuilt
from pyspark.sql import functions as F

WORDS = re.compile("[^\x20\x09-\x0d]+")


def brute(held):
    """held: (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in held:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(c - 20 * int(c / 20)), [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, who in members.items():
        below = [x for x in members if x[: len(node)] == node]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        children = [x for x in below if len(x) == len(node) + 1]
        saved = sum((len(members[x]) - 1) * (len(WORDS.findall(x[-1][1])) if x else 0) for x in below)
        ends = ",".join(str(c) for c in sorted(who) if len(built[c]) == len(node))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def answer(spark, held, **kind):
    df = spark.createDataFrame(held, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as pos", "'x' as depth").repartition(3)
    turns, convs = rebuilt(positions(df))
    out = prefix_trie(turns, convs, **kind)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert all(t == "bigint" for n, t in out.dtypes if n != "ends_sha256")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def talks(seed, n):
    draw = random.Random(seed)
    starts = [[("user", f"start {k} of it"), ("assistant", f"well {k}")] * 3 for k in range(3)]
    out = []
    for c in range(n):
        turns = draw.choice(starts)[: draw.randrange(7)] + [(draw.choice(["user", "system"]), draw.choice(["a b", "c", "", "d e f"])) for _ in range(draw.randrange(6))]
        out += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    return out


@pytest.mark.parametrize("block", [1, 4])
def test_against_brute_force(spark, block):
    held = talks(3, 90)
    assert answer(spark, held, block=block) == brute(held)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK", 8)
    held = [(c, i, "user", "same words here") for c in range(40) for i in range(2)]  # one conversation forty times over
    held += [(-3, 0, None, None), (-3, None, "user", "x"), (-3, None, "user", "x"), (None, 0, "user", "y"), (25, 7, "b", "z"), (25, 7, "a", "z"), (1041, 0, "user", "only one"), (-20, 0, "user", "ab"), (1081, 5, "u", "w " * 3000)]
    assert answer(spark, held) == brute(held)
    assert answer(spark, []) == []
    alone = [(1041, 0, "user", "gone")]  # its only turn is replaced, by nothing
    assert zlib.crc32(b"1041") % 4 == 0 or answer(spark, alone)[0][1] == 0
    assert answer(spark, alone) == brute(alone)


def test_long_conversation_in_segments(spark, monkeypatch):
    monkeypatch.setattr(module, "SEGMENT", 2)
    held = [(c, i, "u", f"t{i % 7}") for c in (1, 2, 21) for i in range(60 - c)]
    held = [(c, i, r, t + ("!" if c == 2 and i == 45 else "")) for c, i, r, t in held]
    assert answer(spark, held, block=3) == brute(held)


def test_only_diverging_blocks_are_refined(spark):
    """A lone block is read off one conversation: no grouping of its turns."""
    held = [(c, i, "u", f"t{i}") for c in range(30) for i in range(8)]
    df = spark.createDataFrame(held, "conv_id bigint, turn bigint, role string, text string")
    turns, convs = rebuilt(positions(df))
    blocks = module.blocks(turns, 4).groupBy(*module.GROUP).agg(F.count("*").alias("n"))
    assert blocks.count() == 2 and blocks.agg(F.min("n")).first()[0] == 30
