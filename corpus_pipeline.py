"""A corpus cleaned and packed for training, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's documents. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.llm.common import table, written
from agrolume.llm.decontaminate import without_leaks
from agrolume.llm.lines import dedup_lines
from agrolume.llm.neardup import near_duplicates
from agrolume.llm.packing import pack
from agrolume.llm.toxicity import fit, without_toxic

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half, learned from the labels of the documents at hand."""
    return without_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One occurrence of each group of like lines; a document that loses all its text this way goes. n_chars follows the text."""
    out = dedup_lines(docs)
    out = out.where((F.col("n_dropped") == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    return out.select([F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group that is linked by five-word shingles."""
    groups = near_duplicates(docs, words=5).where("not kept").select("doc_id").distinct()
    return docs.join(groups, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed: a row per piece of a document with its ids."""
    return pack(docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Fitted weights, edit distances and tokens have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
