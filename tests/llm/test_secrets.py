"""Secret scans against a plain scan in Python, increments of the ledger, odd rows."""

from __future__ import annotations

import dataclasses
import hashlib
import re

import pyarrow.parquet as pq
import pytest
from agrolume.llm import secrets as S
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
KEY = "AKIA" + "A1B2C3D4E5F6G7H8"
TEXTS = [
    None, "", "nothing here", f"a {KEY} b {KEY}", "token = 'abcdefghijklmnop' passwd:short", f"\U0001f600 é {KEY} api_key=\"0123456789abcdef0123\"",
    f"a {KEY} b {KEY}", "deadbeef" * 4, "AKIAshort", "Secret: ABCDEFGHIJKLMN=" + "x " * 50_000 + KEY,
]


def spans(text, rules=S.RULES):
    out = {}
    for r in rules:
        found = [(m.start(), m.end()) for m in re.finditer(r.pattern, text or "", re.ASCII) if len(m[r.group]) >= r.least]
        out[r.name] = found
    return out


def got_of(paths):
    return sorted((r.path, {x.name: [(s.start, s.end) for s in r[x.name]] for x in S.RULES}) for r in paths.collect())


@pytest.fixture
def versions(docs_of):
    # "path" is among the clashing extra columns.
    return docs_of(TEXTS).drop("path").withColumnRenamed("doc_id", "path").withColumn("blob_id", F.lit("x")).withColumn("hex", F.lit(1))


def test_against_plain_scan(versions):
    paths, ledger, findings = S.scan(versions)
    assert got_of(paths) == [(k, spans(t)) for k, t in enumerate(TEXTS)]
    blobs = len({t or "" for t in TEXTS})
    assert ledger.count() == ledger.distinct().count() == findings.count() == blobs * len(S.RULES)


def test_increments_equal_one_scan(versions):
    _, ledger, findings = S.scan(versions.where("path < 5"))
    seen = ledger.count()
    paths, ledger, findings = S.scan(versions, ledger, findings)
    assert got_of(paths) == [(k, spans(t)) for k, t in enumerate(TEXTS)]
    assert ledger.count() == ledger.distinct().count() > seen
    # Nothing is due a second time; a raised rule version is scanned again, and it alone.
    again = S.scan(versions, ledger, findings)
    assert again[1].count() == ledger.count() and got_of(again[0]) == got_of(paths)
    raised = tuple(dataclasses.replace(r, version=2, least=20) if r.name == "access" else r for r in S.RULES)
    paths, grown, _ = S.scan(versions, ledger, findings, raised)
    assert got_of(paths) == [(k, spans(t, raised)) for k, t in enumerate(TEXTS)]
    fresh = grown.exceptAll(ledger)
    assert {(r.rule, r.version) for r in fresh.collect()} == {("access", 2)} and fresh.count() == len({t or "" for t in TEXTS})


def test_odd_rows(spark, versions):
    twice = versions.where("path in (0, 3)").unionByName(versions.where("path = 3")).unionByName(versions.where("path = 3").withColumn("path", F.lit(None).cast("bigint")))
    rows = S.scan(twice)[0].collect()
    assert sorted((-1 if r.path is None else r.path, len(r.access)) for r in rows) == [(-1, 2), (0, 0), (3, 2), (3, 2)]
    none = S.scan(versions.where("false"))
    assert [x.count() for x in none] == [0, 0, 0]


def test_query_against_plain_scan(spark):
    docs = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    got = {r.doc_id: r for r in S.op1_secret_scan(spark, SF).collect()}
    assert len(got) == len(docs["doc_id"])
    for doc_id, t in zip(docs["doc_id"], docs["text"], strict=True):
        found = spans(t)
        listed = sorted((a, k, f"{r.name}:{a}:{b}") for k, r in enumerate(S.RULES) for a, b in found[r.name])
        base = ",".join(x for _, k, x in listed if k < 3)
        row = got[doc_id]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(len(found[n]) for n in ("assign", "access", "hex"))
        assert row.spans == ",".join(x for _, _, x in listed) and row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
