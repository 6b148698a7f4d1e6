"""The registered corpus queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agrolume.llm.annuli import OP13_SQL, op13_vector_search
from agrolume.llm.chat import OP9_SQL, op9_chat_format
from agrolume.llm.decontaminate import op3_decontamination
from agrolume.llm.fingerprints import op10_fingerprints
from agrolume.llm.lines import op8_line_dedup
from agrolume.llm.lm import op5_language_model
from agrolume.llm.neardup import op7_near_duplicates
from agrolume.llm.packing import op2_packing
from agrolume.llm.quality import op4_quality
from agrolume.llm.ranked import OP11_SQL, op11_ranked_search
from agrolume.llm.secrets import OP1_SQL, op1_secret_scan
from agrolume.llm.toxicity import op6_toxicity
from agrolume.llm.trie import OP12_SQL, op12_prefix_trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_language_model": op5_language_model,
    "op6_toxicity": op6_toxicity,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_line_dedup": op8_line_dedup,
    "op9_chat_format": op9_chat_format,
    "op10_fingerprints": op10_fingerprints,
    "op11_ranked_search": op11_ranked_search,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_vector_search": op13_vector_search,
}
ORACLES: dict[str, str] = {"op1_secret_scan": OP1_SQL, "op9_chat_format": OP9_SQL, "op11_ranked_search": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_vector_search": OP13_SQL}
