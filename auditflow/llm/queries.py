"""The registered queries of this package and, where SQL can say it, their SQL."""

from __future__ import annotations

from auditflow.llm import (
    collocations,
    conversations,
    decontaminate,
    language_id,
    licenses,
    line_dedup,
    mixing,
    order_minhash,
    quality,
    simhash,
    substring_dedup,
    token_counts,
    warc,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_language_id": language_id.op2_language_id,
    "op3_document_fingerprints": order_minhash.op3_document_fingerprints,
    "op4_license_scans": licenses.op4_license_scans,
    "op5_mixing": mixing.op5_mixing,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_warc": warc.op8_warc,
    "op9_simhash_near_dedup": simhash.op9_simhash_near_dedup,
    "op10_benchmark_decontamination": decontaminate.op10_benchmark_decontamination,
    "op11_quality_rules": quality.op11_quality_rules,
    "op12_conversation_repair": conversations.op12_conversation_repair,
    "op13_phrase_collocations": collocations.op13_phrase_collocations,
}

ORACLE: dict[str, str] = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op4_license_scans": licenses.OP4_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op6_substring_dedup": substring_dedup.OP6_SQL,
    "op8_warc": warc.OP8_SQL,
    "op10_benchmark_decontamination": decontaminate.OP10_SQL,
    "op11_quality_rules": quality.OP11_SQL,
    "op12_conversation_repair": conversations.OP12_SQL,
    "op13_phrase_collocations": collocations.OP13_SQL,
}
