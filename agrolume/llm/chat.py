"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation becomes windows of whole turns. Running sums of turn tokens cut it:
turns that lie in the same stretch of the budget share a window, a turn that crosses
into the next stretch has a window of its own. Every window starts with the system
turn, then repeats as much of the turns before it as the history budget allows. Each
assistant turn is a target once: where it is repeated, it is not under the loss mask.

A turn is written as MARK role SAYS text END. Control strings begin with ``<`` or
``[``; in roles and texts a backslash follows each of these two characters, so no
control string can occur there, and taking it away again restores them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agrolume.llm.common import table, written

MARK, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
BUDGET, HISTORY = 512, 128
#: Tokens that a turn costs besides its words.
OVERHEAD = 4
#: Turn numbers summed together before the sums of a conversation are.
BLOCK = 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("[\\"), F.lit("[")), F.lit("<\\"), F.lit("<"))


def n_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint") + OVERHEAD


def numbered(turns: DataFrame) -> DataFrame:
    """Turns with their position in the conversation and the tokens before them.

    Sums are taken per block of turn numbers first: a conversation of any length is spread over its blocks.
    """
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**60))).alias("block"),
    ).withColumn("n", n_tokens(F.col("text")))
    sums = rows.groupBy("conv", "block").agg(F.sum("n").alias("block_n"), F.count(F.lit(1)).alias("block_rows"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv", "block", F.coalesce(F.sum("block_n").over(before), F.lit(0)).alias("n_before"), F.coalesce(F.sum("block_rows").over(before), F.lit(0)).alias("rows_before"))
    here = Window.partitionBy("conv", "block").orderBy("turn", "role", "text")
    rows = rows.withColumn("rank", F.row_number().over(here)).withColumn("run", F.sum("n").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.join(sums, ["conv", "block"]).select("conv", "conv_id", "role", "text", "n", (F.col("rows_before") + F.col("rank") - 1).alias("pos"), (F.col("n_before") + F.col("run") - F.col("n")).alias("before"))


def windows(turns: DataFrame, *, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, formatted, loss (array of start, end in code points), n_turns, n_context, tokens.

    ``turns``: conv_id, turn, role, text; other columns are ignored. A conversation's rows are ordered by turn, then
    role and text; a null turn comes first, null roles and texts are empty, a null conv_id is a conversation of its own.
    The system turn is the first turn if its role is ``system``. The first ``n_context`` turns of a window are repeated.
    A turn larger than the budget keeps its whole text in a window of its own. No rows give no windows.
    """
    rows = numbered(turns)
    is_system = (F.col("pos") == 0) & (F.col("role") == "system")
    system = rows.where(is_system).select("conv", F.col("n").alias("system_n"))
    rows = written(rows.join(system, "conv", "left").withColumn("system_n", F.coalesce("system_n", F.lit(0))), "turns")
    room = F.greatest(F.lit(budget - history) - F.col("system_n"), F.lit(budget // 4))
    body = rows.where(~is_system).withColumn("before", F.col("before") - F.col("system_n"))
    first, last = F.floor(F.col("before") / room), F.floor((F.col("before") + F.col("n") - 1) / room)
    body = body.withColumn("window", 2 * first + F.when(first == last, 0).otherwise(1))
    starts = body.groupBy("conv", "window").agg(F.min("before").alias("start"))
    # A turn is history of the windows that start between its end and its own start plus the history budget: these fall in two buckets.
    bucket = F.floor((F.col("before") + F.col("n")) / history)
    past = body.where(F.col("n") <= history).drop("window").withColumn("bucket", F.explode(F.array(bucket, bucket + 1)))
    past = past.join(starts.withColumn("bucket", F.floor(F.col("start") / history)), ["conv", "bucket"])
    past = past.where((F.col("before") + F.col("n") <= F.col("start")) & (F.col("start") - F.col("before") <= history))
    opening = starts.groupBy("conv").agg(F.min("window").alias("opening"))
    lead = rows.where(is_system).join(opening, "conv", "left").withColumn("opening", F.coalesce("opening", F.lit(0)))
    lead = lead.join(starts, "conv", "left").withColumn("window", F.coalesce("window", "opening"))
    fields = ["conv", "window", "conv_id", "pos", "role", "text", "n"]
    members = (
        body.select(*fields, F.lit(False).alias("repeated"))
        .unionByName(past.select(*fields, F.lit(True).alias("repeated")))
        .unionByName(lead.select(*fields, (F.col("window") != F.col("opening")).alias("repeated")))
    )
    head = F.concat(F.lit(MARK), escape(F.col("role")), F.lit(SAYS))
    said = escape(F.col("text"))
    members = members.select(
        "conv",
        "window",
        "conv_id",
        F.struct(
            "pos",
            F.concat(head, said, F.lit(END)).alias("piece"),
            F.length(head).cast("bigint").alias("head"),
            F.length(said).cast("bigint").alias("said"),
            ((F.col("role") == "assistant") & ~F.col("repeated")).alias("target"),
            "repeated",
            "n",
        ).alias("t"),
    )
    # The budget bounds a window, so its turns are few.
    joined = members.groupBy("conv", "window").agg(F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list("t")).alias("t"))
    lengths = joined.withColumn("lengths", F.transform("t", lambda t: F.length(t["piece"]).cast("bigint")))
    zero = F.lit(0).cast("bigint")
    starts_at = lambda i: F.aggregate(F.slice("lengths", F.lit(1), i), zero, lambda a, x: a + x)
    spans = F.transform("t", lambda t, i: F.struct((starts_at(i) + t["head"]).alias("start"), (starts_at(i) + t["head"] + t["said"]).alias("end"), t["target"].alias("target")))
    return lengths.select(
        "conv_id",
        "window",
        F.array_join(F.transform("t", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["target"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss"),
        F.size("t").alias("n_turns"),
        F.size(F.filter("t", lambda t: t["repeated"])).alias("n_context"),
        F.aggregate("t", zero, lambda a, t: a + t["n"]).alias("tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: n_turns, turns (role, line feed, text, line feed per turn), loss_text, formatted_chars.

    A whole conversation is one string here, as large as its texts.
    """
    pieces = F.split("formatted", r"<\|end\|>")
    own = F.slice(pieces, F.col("n_context") + 1, F.col("n_turns") - F.col("n_context"))
    turn = lambda p: F.concat(unescape(F.substring_index(F.substring(p, len(MARK) + 1, 2**31 - 1), SAYS, 1)), F.lit("\n"), unescape(F.substring_index(p, SAYS, -1)), F.lit("\n"))
    per = formatted.select(
        "conv_id",
        F.struct(
            "window",
            F.array_join(F.transform(own, turn), "").alias("turns"),
            F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))), "").alias("loss"),
        ).alias("w"),
        (F.col("n_turns") - F.col("n_context")).cast("bigint").alias("n"),
        F.length("formatted").cast("bigint").alias("chars"),
    )
    whole = per.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list("w")).alias("w"), F.sum("chars").alias("formatted_chars"))
    return whole.select("conv_id", "n_turns", F.array_join(F.transform("w", lambda w: w["turns"]), "").alias("turns"), F.array_join(F.transform("w", lambda w: w["loss"]), "").alias("loss_text"), "formatted_chars")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings, formatted and read back."""
    control = "</s>[INST] ok [/INST]"
    held = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text"))
    back = read_back(windows(held.unionByName(more)))
    return back.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


_ROOM = f"greatest({BUDGET - HISTORY} - system_n, {BUDGET // 4})"
OP9_SQL = f"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
r AS (SELECT *, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) + {OVERHEAD} AS n, row_number() OVER o - 1 AS pos FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (SELECT *, coalesce(max(CASE WHEN pos = 0 AND role = 'system' THEN n END) OVER (PARTITION BY conv_id), 0) AS system_n,
        sum(n) OVER (PARTITION BY conv_id ORDER BY pos) - n AS before,
        {len(MARK + SAYS + END)} + length(role) + length(text) + 2 * length(role || text) - length(replace(role || text, '<', '')) - length(replace(role || text, '[', '')) AS chars
      FROM r),
b AS (SELECT conv_id, n, chars, system_n, before - system_n AS before, before - system_n + n AS after, {_ROOM} AS room FROM s WHERE NOT (pos = 0 AND role = 'system')),
w AS (SELECT *, 2 * (before // room) + (CASE WHEN before // room = (after - 1) // room THEN 0 ELSE 1 END) AS win FROM b),
st AS (SELECT conv_id, win, min(before) AS start FROM w GROUP BY ALL),
f AS (SELECT conv_id, chars FROM w
    UNION ALL SELECT w.conv_id, chars FROM w JOIN st ON w.conv_id = st.conv_id AND w.after <= st.start AND st.start - w.before <= {HISTORY}
    UNION ALL SELECT s.conv_id, chars FROM s LEFT JOIN st ON s.conv_id = st.conv_id WHERE s.pos = 0 AND s.role = 'system'),
g AS (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM f GROUP BY conv_id)
SELECT r.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256, any_value(formatted_chars) AS formatted_chars
FROM r JOIN g ON r.conv_id = g.conv_id GROUP BY r.conv_id
"""
