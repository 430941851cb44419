"""One query for each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import contamination, inverted_index, merkle, mixing, nn_descent, pieces, quality, reply_trees, secret_scan, signature_trees, spelling, substring, token_frames

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_frames": token_frames.op1,
    "op2_inverted_multi_index": inverted_index.op2,
    "op3_nn_descent": nn_descent.op3,
    "op4_source_mixing": mixing.op4,
    "op5_randomness_secrets": secret_scan.op5,
    "op6_signature_trees": signature_trees.op6,
    "op7_substring_dedup": substring.op7,
    "op8_fourier_quality": quality.op8,
    "op9_sentencepiece_scan": pieces.op9,
    "op10_reply_trees": reply_trees.op10,
    "op11_merkle_witnesses": merkle.op11,
    "op12_suffix_automaton": contamination.op12,
    "op13_spelling_trees": spelling.op13,
}
ORACLE_SQL: dict[str, str] = {
    "op2_inverted_multi_index": inverted_index.ORACLE_SQL,
    "op3_nn_descent": nn_descent.ORACLE_SQL,
    "op4_source_mixing": mixing.ORACLE_SQL,
    "op6_signature_trees": signature_trees.ORACLE_SQL,
    "op7_substring_dedup": substring.ORACLE_SQL,
    "op10_reply_trees": reply_trees.ORACLE_SQL,
    "op11_merkle_witnesses": merkle.ORACLE_SQL,
    "op12_suffix_automaton": contamination.ORACLE_SQL,
    "op13_spelling_trees": spelling.ORACLE_SQL,
}
