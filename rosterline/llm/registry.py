"""The queries of this subpackage and, where SQL can express them, their SQL texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rosterline.llm import alignment, chat_preferences, decontamination, jaccard_join, language_id, license_scan, line_dedup, mixing, nearest_neighbours, suffix_tree_lm, token_output, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest_neighbours": nearest_neighbours.op1,
    "op2_language_id": language_id.op2,
    "op3_decontamination": decontamination.op3,
    "op4_license_scan": license_scan.op4,
    "op5_chat_preferences": chat_preferences.op5,
    "op6_line_dedup": line_dedup.op6,
    "op7_suffix_tree_lm": suffix_tree_lm.op7,
    "op8_jaccard_join": jaccard_join.op8,
    "op9_token_records": token_output.op9,
    "op10_mixing": mixing.op10,
    "op11_token_alignment": alignment.op11,
    "op12_toxicity": toxicity.op12,
    "op13_whitening": whitening.op13,
}

ORACLE: dict[str, str] = {
    "op5_chat_preferences": chat_preferences.ORACLE_SQL,
    "op6_line_dedup": line_dedup.ORACLE_SQL,
    "op10_mixing": mixing.ORACLE_SQL,
}
