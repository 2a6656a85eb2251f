"""The corpus queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

from tracecut.llm import decontaminate, jaccard, language, packing, quality, secrets, substrings, tokens, toxicity, urls


def queries():
    return {
        "op1_suffix_dedup": substrings.op1,
        "op2_quality_rules": quality.op2,
        "op3_decontamination": decontaminate.op3,
        "op4_language_id": language.op4,
        "op5_url_filters": urls.op5,
        "op6_secret_scans": secrets.op6,
        "op7_packing": packing.op7,
        "op8_toxicity": toxicity.op8,
        "op9_jaccard_join": jaccard.op9,
        "op10_token_counts": tokens.op10,
    }


def oracle_sql():
    return {
        "op2_quality_rules": quality.sql(),
        "op5_url_filters": urls.sql(),
        "op9_jaccard_join": jaccard.sql(),
    }
