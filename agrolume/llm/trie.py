"""Prefix trie of conversations by fixed-length block hashing.

A turn's hash holds its depth, so the turns of any stretch combine by exclusive or: a block of BLOCK turns has a digest, and
what precedes it has one. Conversations are grouped by the digests of successive blocks first. Where a block has
no sibling, all that enter it share its turns, and its nodes are read off one conversation. Only blocks that have siblings
are refined: their distinct contents, not their conversations, are met turn by turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agrolume.llm.common import ship, table, written

BLOCK = 4
#: Blocks summed together before the sums of a conversation are.
SEGMENT = 1024
#: Conversations of one family, and turns that they may share with their first one.
FAMILY, SHARED = 20, 4
#: Bytes of conversation ids that travel to a digest in one row.
CHUNK = 1 << 20
NODE = ["depth", "k1", "k2"]
GROUP = ["block", "p1", "p2", "b1", "b2", "size"]


def positions(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), h1, h2 (128 bits of role and text), words: a written table of all turns that have a conv_id.

    A conversation is ordered by turn (null first), then role and text. Rows are dealt by range, so one of any
    length lies in many parts; its rows are counted per part first.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    order = [F.asc("conv_id"), F.asc_nulls_first("turn")]
    dealt = rows.repartitionByRange(*order, F.substring("role", 1, 64), F.substring("text", 1, 64)).sortWithinPartitions(*order, "role", "text")
    at = F.monotonically_increasing_id()
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    dealt = written(dealt.select("conv_id", F.shiftright(at, 33).alias("part"), at.alias("at"), F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("again"), "role", "text").alias("h2"), words.alias("words")), "dealt-turns")
    per = dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return written(dealt.join(per, ["conv_id", "part"]).select("conv_id", (F.col("before") + F.col("at") - F.col("first")).alias("pos"), "h1", "h2", "words"), "turns")


def rebuilt(turns: DataFrame, *, family: int = FAMILY, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) of families: conversation c takes its first h turns from conversation c - c % family.

    h is the checksum of c's decimal digits modulo ``shared``; then come c's own turns after its first h. ``turns``:
    conv_id, pos, h1, h2, words as ``positions`` returns them. Conversations (conv_id) are all of those, also if no turn is left.
    """
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    takes = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    convs = lengths.select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("donor"), takes.alias("h"))
    donors = lengths.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("donor"), F.least("n", F.lit(shared - 1)).alias("has"))
    convs = convs.join(donors, "donor", "left").select("conv_id", "donor", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("got"))
    convs = written(convs, "families")
    given = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < shared - 1)).withColumnRenamed("conv_id", "donor")
    copied = convs.where("got > 0").join(given, "donor").where("pos < got").select("conv_id", (F.col("pos") + 1).alias("depth"), "h1", "h2", "words")
    own = turns.join(convs.select("conv_id", "h", "got"), "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("got") + 1).alias("depth"), "h1", "h2", "words")
    return copied.unionByName(own), convs.select("conv_id")


def blocks(turns: DataFrame, block: int) -> DataFrame:
    """Blocks of the conversations: turns, their digest, and digest and words of all turns before."""
    t = turns.select("conv_id", F.floor((F.col("depth") - 1) / block).alias("block"), F.struct("depth", F.xxhash64("depth", "h1").alias("t1"), F.xxhash64("depth", "h2").alias("t2"), "words").alias("t"))
    rows = t.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("t")).alias("turns"), F.bit_xor("t.t1").alias("b1"), F.bit_xor("t.t2").alias("b2"), F.count(F.lit(1)).alias("size"), F.sum("t.words").alias("w"))
    rows = written(rows.withColumn("segment", F.floor(F.col("block") / SEGMENT)), "blocks")
    zero = F.lit(0).cast("bigint")
    sums = {"p1": F.bit_xor("b1"), "p2": F.bit_xor("b2"), "before": F.sum("w")}
    over = Window.partitionBy("conv_id", "segment").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    within = rows.select("*", *[F.coalesce(f.over(over), zero).alias(f"in_{c}") for c, f in sums.items()])
    per = rows.groupBy("conv_id", "segment").agg(*[f.alias(f"s_{c}") for c, f in sums.items()])
    over = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("conv_id", "segment", *[F.coalesce((F.sum if c == "before" else F.bit_xor)(f"s_{c}").over(over), zero).alias(f"at_{c}") for c in sums])
    joined = within.join(per, ["conv_id", "segment"])
    return joined.select("conv_id", "block", F.col("in_p1").bitwiseXOR(F.col("at_p1")).alias("p1"), F.col("in_p2").bitwiseXOR(F.col("at_p2")).alias("p2"), (F.col("in_before") + F.col("at_before")).alias("before"), "b1", "b2", "size", "w", "turns")


def _spots(groups: DataFrame, held: DataFrame) -> DataFrame:
    """A row per turn of each distinct block: the node that it is, read off the block's first conversation."""
    said = held.select(F.col("conv_id").alias("rep"), "block", "before", "turns")
    rows = groups.join(said, ["rep", "block"]).select(*GROUP, "rep", "n", "before", "turns", F.posexplode("turns").alias("i", "t"))
    upto = F.slice("turns", F.lit(1), F.col("i") + 1)
    k1 = F.aggregate(upto, F.col("p1"), lambda a, t: a.bitwiseXOR(t["t1"]))
    k2 = F.aggregate(upto, F.col("p2"), lambda a, t: a.bitwiseXOR(t["t2"]))
    before = F.col("before") + F.aggregate(F.slice("turns", F.lit(1), F.col("i")), F.lit(0).cast("bigint"), lambda a, t: a + t["words"])
    rows = rows.select(*GROUP, "rep", "n", F.col("t.depth").alias("depth"), k1.alias("k1"), k2.alias("k2"), "t", before.alias("before"))
    return rows.select(*GROUP, "rep", "n", *NODE, F.col("k1").bitwiseXOR(F.col("t.t1")).alias("up1"), F.col("k2").bitwiseXOR(F.col("t.t2")).alias("up2"), F.col("t.words").alias("words"), "before")


def digests(ends: DataFrame) -> DataFrame:
    """NODE, ends_sha256: of the decimal conv_ids that end at a node, ascending, comma-joined.

    Ids are sorted by range and joined to chunks where they lie; one pass over a node's chunks hashes them, holding one at a time.
    """
    ship(ends.sparkSession)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[pa.array([r[i] for r in done], pa.int64()) for i in range(4)], pa.array([r[4] for r in done], pa.string())], names=[*NODE, "first", "ids"])

        key, first, ids, size = None, 0, [], 0
        for batch in batches:
            done = []
            for *node, conv in zip(*[batch.column(c).to_pylist() for c in (*NODE, "conv_id")], strict=True):
                if node != key or size >= CHUNK:
                    if ids:
                        done.append((*key, first, ",".join(ids)))
                    key, first, ids, size = node, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            yield rows_of(done)
        if ids:
            yield rows_of([(*key, first, ",".join(ids))])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[pa.array([r[i] for r in done], pa.int64()) for i in range(3)], pa.array([r[3] for r in done], pa.string())], names=[*NODE, "ends_sha256"])

        key, sha = None, None
        for batch in batches:
            done = []
            for *node, ids in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")], strict=True):
                if node == key:
                    sha.update(b"," + ids.encode())
                else:
                    if key:
                        done.append((*key, sha.hexdigest()))
                    key, sha = node, hashlib.sha256(ids.encode())
            yield rows_of(done)
        if key:
            yield rows_of([(*key, sha.hexdigest())])

    keys = "depth bigint, k1 bigint, k2 bigint"
    order = [*NODE, "conv_id"]
    joined = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(chunks, f"{keys}, first bigint, ids string")
    return joined.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(hashed, f"{keys}, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """A row per distinct sequence of first turns (a node), from the root of no turns on.

    ``turns``: conv_id, depth (from 1, without gaps), h1, h2, words; ``conversations``: conv_id, each once, also those without
    turns. Returns conv_id (the smallest that starts with it), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves and saved_tokens of its subtree, ends_sha256 of the conversations that end there. Equal turns have equal
    128 bits. No conversations give no nodes.
    """
    held = written(blocks(turns, block), "chained-blocks")
    groups = written(held.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("rep")), "block-groups")
    family = ["block", "p1", "p2"]
    siblings = groups.groupBy(*family).agg(F.count(F.lit(1)).alias("c"))
    several = written(_spots(groups.join(siblings.where("c > 1"), family, "left_semi"), held), "diverging")
    lone = written(_spots(groups.join(siblings.where("c = 1"), family, "left_semi"), held), "lone")
    fields = [*NODE, "up1", "up2", "conv_id", "n_convs", "words", "before"]
    refined = several.groupBy(*NODE).agg(*[F.min(c).alias(c) for c in ("up1", "up2", "words", "before")], F.min("rep").alias("conv_id"), F.sum("n").alias("n_convs"))
    zero = F.lit(0).cast("bigint")
    root = conversations.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in NODE], zero.alias("up1"), zero.alias("up2"), "conv_id", "n_convs", zero.alias("words"), zero.alias("before"))
    nodes = refined.select(fields).unionByName(lone.withColumnsRenamed({"rep": "conv_id", "n": "n_convs"}).select(fields)).unionByName(root)
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("k1"), F.col("up2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(kids, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes")

    # What a conversation adds to the sums of all nodes that it starts with: its words before the first node that it stands for,
    # which are repeated there, and one leaf if it stands for a node without children.
    whole = held.groupBy("conv_id").agg(F.sum("size").alias("depth"), F.bit_xor("b1").alias("k1"), F.bit_xor("b2").alias("k2"), F.sum("w").alias("total"))
    whole = conversations.join(whole, "conv_id", "left").select("conv_id", *[F.coalesce(c, zero).alias(c) for c in (*NODE, "total")])
    stands = nodes.groupBy("conv_id").agg(F.min_by("before", "depth").alias("unshared"), F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf"))
    adds = whole.join(stands, "conv_id", "left").select("conv_id", *NODE, F.coalesce("unshared", "total").alias("repeated"), F.coalesce("leaf", zero).alias("leaf"))
    adds = written(adds, "conversations")
    sums = held.join(adds.select("conv_id", "repeated", "leaf"), "conv_id").groupBy(*GROUP).agg(F.sum("repeated").alias("repeated"), F.sum("leaf").alias("n_leaves"), F.min_by("repeated", "conv_id").alias("own"))
    spots = several.unionByName(lone).select(*GROUP, *NODE, "rep").join(sums, GROUP)
    sums = spots.groupBy(*NODE).agg(F.sum("repeated").alias("repeated"), F.sum("n_leaves").alias("n_leaves"), F.min_by("own", "rep").alias("own"))
    top = adds.agg(F.sum("repeated").alias("repeated"), F.sum("leaf").alias("n_leaves")).where("n_leaves is not null").select(*[zero.alias(c) for c in NODE], "repeated", "n_leaves", zero.alias("own"))

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums.unionByName(top), NODE).join(digests(adds.select(*NODE, "conv_id")), NODE, "left").join(parents, ["depth", "up1", "up2"], "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("repeated") - F.col("own") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations.

    ``conversations`` as ``positions`` takes them: null roles and texts are empty, rows without conv_id take no part, repeated
    rows are turns each. Other columns are ignored.
    """
    turns, conversations = rebuilt(positions(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))
    return prefix_trie(written(turns, "rebuilt"), conversations)


_STEPS = "flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
_CRC = f"xor(list_reduce({_STEPS}, lambda c, s: xor(xor(c, s) >> 1, 3988292384 * (xor(c, s) & 1)), 4294967295::BIGINT), 4294967295::BIGINT)"
OP12_SQL = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
        {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS turn, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS words
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_CRC} % {SHARED} AS h FROM (SELECT DISTINCT conv_id FROM t)),
f AS (SELECT c.conv_id, 0 AS own, t.pos, turn, words FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % {FAMILY} AND t.pos <= h
    UNION ALL SELECT c.conv_id, 1, t.pos, turn, words FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > h),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth, turn, words FROM f),
l AS (SELECT c.conv_id, coalesce(list(turn ORDER BY depth) FILTER (turn IS NOT NULL), []) AS turns, coalesce(list(words ORDER BY depth) FILTER (turn IS NOT NULL), []) AS words FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
m AS (SELECT conv_id, turns, words, unnest(range(0, len(turns) + 1)) AS depth FROM l),
n AS (SELECT depth, list_slice(turns, 1, depth) AS node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(CASE WHEN depth = 0 THEN 0 ELSE words[depth] END) AS words,
        string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth) AS ends
    FROM m GROUP BY depth, list_slice(turns, 1, depth)),
k AS (SELECT n.*, p.conv_id AS parent_conv_id FROM n LEFT JOIN n p ON p.depth = n.depth - 1 AND p.node = list_slice(n.node, 1, n.depth - 1)),
ch AS (SELECT depth - 1 AS depth, list_slice(node, 1, depth - 1) AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
x AS (SELECT k.*, coalesce(n_children, 0) AS n_children FROM k LEFT JOIN ch USING (depth, node)),
up AS (SELECT node AS below, n_convs, words, n_children, unnest(range(0, depth + 1)) AS depth FROM x),
s AS (SELECT depth, list_slice(below, 1, depth) AS node, sum((n_convs - 1) * words) AS saved, sum((n_children = 0)::BIGINT) AS leaves FROM up GROUP BY ALL)
SELECT x.conv_id, x.depth, x.parent_conv_id, x.n_convs, x.n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(x.ends, '')) AS ends_sha256
FROM x JOIN s USING (depth, node)
"""
