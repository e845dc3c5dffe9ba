"""Registered queries of the operators and the SQL of those SQL can express."""

from __future__ import annotations

from casework.llm import (
    conversation_repair, decontaminate, embedding_dedup, html_extract, language_id, license_scan, ngram_join, packing, pii, run_detection, substring_dedup, suffix_dedup, warc,
)

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_warc": warc.op2_warc,
    "op3_license_scan": license_scan.op3_license_scan,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_packing": packing.op5_packing,
    "op6_pii": pii.op6_pii,
    "op7_language_id": language_id.op7_language_id,
    "op8_html_extract": html_extract.op8_html_extract,
    "op9_embedding_dedup": embedding_dedup.op9_embedding_dedup,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_run_detection": run_detection.op11_run_detection,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_suffix_dedup": suffix_dedup.op13_suffix_dedup,
}

SQL = {
    "op1_substring_dedup": substring_dedup.ORACLE_SQL,
    "op2_warc": warc.ORACLE_SQL,
    "op3_license_scan": license_scan.ORACLE_SQL,
    "op4_ngram_join": ngram_join.ORACLE_SQL,
    "op9_embedding_dedup": embedding_dedup.ORACLE_SQL,
    "op11_run_detection": run_detection.ORACLE_SQL,
    "op12_conversation_repair": conversation_repair.ORACLE_SQL,
    "op13_suffix_dedup": suffix_dedup.ORACLE_SQL,
}
