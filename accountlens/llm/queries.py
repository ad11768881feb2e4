"""The registered queries of this subpackage, and DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from accountlens.llm import (
    alignment, chat, classifier, html_text, katz, language, lines, pieces, quality_rules, resampling, simhash, suffixes, tiling,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": classifier.query,
    "op2_decontamination": tiling.query,
    "op3_simhash_near_dedup": simhash.query,
    "op4_suffix_dedup": suffixes.query,
    "op5_lm_scoring": katz.query,
    "op6_sentencepiece": pieces.query,
    "op7_quality_rules": quality_rules.query,
    "op8_language_id": language.query,
    "op9_chat_formatting": chat.query,
    "op10_html_extraction": html_text.query,
    "op11_importance_resampling": resampling.query,
    "op12_line_dedup": lines.query,
    "op13_cross_tokenizer_alignment": alignment.query,
}

STATEMENTS: dict[str, str] = {
    "op9_chat_formatting": chat.STATEMENT,
    "op11_importance_resampling": resampling.STATEMENT,
    "op12_line_dedup": lines.STATEMENT,
}
