"""Registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import codes, html, jaccard, langid, lines, mixing, orc_tokens, packing, passages, pii, quality, topk, trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": jaccard.op1_jaccard_join,
    "op2_mixing": mixing.op2_mixing,
    "op3_top_k": topk.op3_top_k,
    "op4_packing": packing.op4_packing,
    "op5_language_id": langid.op5_language_id,
    "op6_substring_dedup": passages.op6_substring_dedup,
    "op7_line_dedup": lines.op7_line_dedup,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_pii": pii.op9_pii,
    "op10_orc_tokens": orc_tokens.op10_orc_tokens,
    "op11_prefix_trie": trie.op11_prefix_trie,
    "op12_vector_codes": codes.op12_vector_codes,
    "op13_html_extraction": html.op13_html_extraction,
}

ORACLES: dict[str, str] = {
    "op1_jaccard_join": jaccard.OP1_SQL,
    "op2_mixing": mixing.OP2_SQL,
    "op3_top_k": topk.OP3_SQL,
    "op6_substring_dedup": passages.OP6_SQL,
    "op11_prefix_trie": trie.OP11_SQL,
    "op12_vector_codes": codes.OP12_SQL,
}
