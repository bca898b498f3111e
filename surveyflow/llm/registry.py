"""The queries of this package and, where SQL can express them, their statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from surveyflow.llm import (
    bpe,
    exact_dedup,
    filter_audit,
    hard_negatives,
    html_extract,
    language_id,
    lm_score,
    mixing,
    private_terms,
    quality_mil,
    quality_rules,
    simhash,
    substring_dedup,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": exact_dedup.query,
    "op2_mixing": mixing.query,
    "op3_quality_rules": quality_rules.query,
    "op4_language_id": language_id.query,
    "op5_substring_dedup": substring_dedup.query,
    "op6_html_extract": html_extract.query,
    "op7_lm_score": lm_score.query,
    "op8_bpe": bpe.query,
    "op9_simhash": simhash.query,
    "op10_quality_mil": quality_mil.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_filter_audit": filter_audit.query,
    "op13_private_terms": private_terms.query,
}

SQL: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op2_mixing": mixing.SQL,
    "op5_substring_dedup": substring_dedup.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_filter_audit": filter_audit.SQL,
}
