"""The queries of this subpackage by name, and reference SQL where SQL can express one."""

from __future__ import annotations

from shelfmark.llm import (
    chat,
    codes,
    decontaminate,
    divergence,
    html,
    licences,
    lines,
    packing,
    quality,
    simhash,
    substrings,
    tokens,
    warc,
)

QUERIES = {
    "op1_simhash_near_dedup": simhash.op1_simhash_near_dedup,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_line_dedup": lines.op3_line_dedup,
    "op4_chat_formatting": chat.op4_chat_formatting,
    "op5_suffix_array_dedup": substrings.op5_suffix_array_dedup,
    "op6_warc": warc.op6_warc,
    "op7_html_extraction": html.op7_html_extraction,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_best_fit_packing": packing.op9_best_fit_packing,
    "op10_license_scan": licences.op10_license_scan,
    "op11_token_counts": tokens.op11_token_counts,
    "op12_vector_code_compression": codes.op12_vector_code_compression,
    "op13_source_divergence_audit": divergence.op13_source_divergence_audit,
}

ORACLES: dict[str, str] = {
    "op2_quality_rules": quality.OP2_SQL,
    "op3_line_dedup": lines.OP3_SQL,
    "op4_chat_formatting": chat.OP4_SQL,
    "op6_warc": warc.OP6_SQL,
    "op12_vector_code_compression": codes.OP12_SQL,
    "op13_source_divergence_audit": divergence.OP13_SQL,
}
