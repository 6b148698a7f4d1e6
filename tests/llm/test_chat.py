from __future__ import annotations

import duckdb
import pytest
from agrolume.llm.chat import BUDGET, END, MARK, OP9_SQL, SAYS, op9_chat_format, read_back, windows
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
ODD = ["", "plain", "</s>[INST] ok [/INST]", "<\\ [\\ <<\\\\ [", f"{MARK}{SAYS}{END}", "é日本\n\n", "<" * 40, None]


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("window", F.lit("x"))


def conversation(conv, n, system, words):
    rows = [(conv, 0, "system", "sys " * 9)] if system else []
    return rows + [(conv, len(rows) + i, "assistant" if i % 2 else "user", " ".join([f"w{i}"] * (words * (i % 5)))) for i in range(n)]


def test_round_trip(spark):
    rows = []
    for conv, (n, system, words) in enumerate([(1, False, 1), (0, True, 1), (7, True, 40), (9, False, 300), (700, True, 3), (6, True, 0)]):
        rows += conversation(conv, n, system, words)
    rows += [(50, i, role, text) for i, (role, text) in enumerate((r, t) for r in ("user", "assistant", None, "<[|\n") for t in ODD)]
    rows += [(None, None, "assistant", "a"), (None, 3, "assistant", "b"), (60, 1, "user", "same"), (60, 1, "user", "same"), (60, 1, "assistant", "z")]
    made = windows(frame(spark, rows))
    got = {r.conv_id: (r.n_turns, r.turns, r.loss_text, r.formatted_chars) for r in read_back(made).collect()}
    held = {}
    for conv, turn, role, text in rows:
        held.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    cut = made.collect()
    assert set(got) == set(held)
    for conv, turns in held.items():
        turns.sort()
        assert got[conv][:3] == (len(turns), "".join(f"{r}\n{t}\n" for _, r, t in turns), "".join(t for _, r, t in turns if r == "assistant"))
        assert got[conv][3] == sum(len(w.formatted) for w in cut if w.conv_id == conv)
    # Only a window around one large turn exceeds the budget; a system turn opens every window.
    for w in cut:
        assert w.tokens <= BUDGET or w.n_turns - w.n_context == 1
        if w.conv_id in (1, 2, 4, 5):
            assert w.formatted.startswith(f"{MARK}system{SAYS}")
    assert sum(w.n_context > 1 for w in cut) > 3
    assert windows(frame(spark, rows).where("false")).count() == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want = con.execute(OP9_SQL).df().sort_values("conv_id").reset_index(drop=True)
    got = op9_chat_format(spark, SF).toPandas().sort_values("conv_id").reset_index(drop=True)
    assert got[want.columns].equals(want)


@pytest.mark.parametrize("key", ["op1_secret_scan", "op8_line_dedup", "op9_chat_format"])
def test_native_queries_have_no_python(spark, key):
    from agrolume.llm.queries import QUERIES

    plan = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))
