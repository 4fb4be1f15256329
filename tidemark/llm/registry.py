"""Queries of this package for the driver's entry point, and their SQL where SQL can express them."""

from __future__ import annotations

from tidemark.llm import oracles
from tidemark.llm.decontaminate import op7_decontaminate
from tidemark.llm.license_scan import op3_license_scan
from tidemark.llm.ngram_join import op1_ngram_jaccard_join
from tidemark.llm.phrase_dedup import op2_phrase_dedup
from tidemark.llm.pii import op8_personal_data
from tidemark.llm.quality_crf import op9_quality_classifier
from tidemark.llm.rule_forest import op6_quality_rules
from tidemark.llm.source_mix import op4_mix_sources
from tidemark.llm.token_output import op5_token_output
from tidemark.llm.toxic_crf import op10_toxicity

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_phrase_dedup": op2_phrase_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_mix_sources": op4_mix_sources,
    "op5_token_output": op5_token_output,
    "op6_quality_rules": op6_quality_rules,
    "op7_decontaminate": op7_decontaminate,
    "op8_personal_data": op8_personal_data,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_toxicity": op10_toxicity,
}

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": oracles.NGRAM_JOIN,
    "op2_phrase_dedup": oracles.PHRASE_DEDUP,
    "op4_mix_sources": oracles.MIX_SOURCES,
    "op7_decontaminate": oracles.DECONTAMINATE,
}
