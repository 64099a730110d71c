"""The registered queries of this folder, and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from lakestrata.llm import (
    byte_bpe,
    conversation_repair,
    decontaminate,
    html_text,
    language_id,
    lm_score,
    near_dups,
    quality_fm,
    quality_rules,
    repeats,
    secret_scan,
    token_store,
    va_clusters,
)

QUERIES = {
    fn.__name__: fn
    for fn in (
        token_store.op1_token_store,
        html_text.op2_html_text,
        byte_bpe.op3_byte_bpe,
        lm_score.op4_lm_score,
        decontaminate.op5_decontamination,
        near_dups.op6_near_dups,
        language_id.op7_language_id,
        quality_fm.op8_quality_fm,
        repeats.op9_substring_dedup,
        quality_rules.op10_quality_rules,
        conversation_repair.op11_conversation_repair,
        va_clusters.op12_centroid_clusters,
        secret_scan.op13_secret_scan,
    )
}

ORACLES: dict[str, str] = {
    "op5_decontamination": decontaminate.ORACLE,
    "op6_near_dups": near_dups.ORACLE,
    "op9_substring_dedup": repeats.ORACLE,
    "op11_conversation_repair": conversation_repair.ORACLE,
    "op12_centroid_clusters": va_clusters.ORACLE,
    "op13_secret_scan": secret_scan.ORACLE,
}
