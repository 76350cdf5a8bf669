"""Registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from panelmill.llm.chat import op2_chat_format
from panelmill.llm.decontaminate import op3_decontamination
from panelmill.llm.katz import op10_katz
from panelmill.llm.licenses import op4_licenses
from panelmill.llm.pieces import op9_sentencepiece
from panelmill.llm.quality import op5_quality_classifier
from panelmill.llm.rules import op6_quality_rules
from panelmill.llm.simhash import op8_simhash
from panelmill.llm.spelling import op13_spelling_variants
from panelmill.llm.substrings import op7_substring_dedup
from panelmill.llm.suffixes import op11_suffix_dedup
from panelmill.llm.token_counts import op1_token_counts
from panelmill.llm.tries import op12_prefix_trie

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_chat_format": op2_chat_format,
    "op3_decontamination": op3_decontamination,
    "op4_licenses": op4_licenses,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_quality_rules": op6_quality_rules,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_simhash": op8_simhash,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_katz": op10_katz,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE: dict[str, str] = {}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
