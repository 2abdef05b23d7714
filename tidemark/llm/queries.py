"""The operators over the given tables, and SQL for those that it can express."""

from __future__ import annotations

from . import (
    credentials,
    langid,
    lines,
    mixing,
    negatives,
    packing,
    quality,
    search,
    simhash,
    spans,
    toxicity,
    urls,
    winnow,
)

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_pack_sequences": packing.op2_pack_sequences,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_substring_dedup": spans.op5_substring_dedup,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_url_filters": urls.op7_url_filters,
    "op8_simhash": simhash.op8_simhash,
    "op9_winnowing": winnow.op9_winnowing,
    "op10_language_id": langid.op10_language_id,
    "op11_ranked_search": search.op11_ranked_search,
    "op12_secret_scan": credentials.op12_secret_scan,
    "op13_hard_negatives": negatives.op13_hard_negatives,
}
ORACLES = {
    "op1_mix_sources": mixing.ORACLE_OP1,
    "op3_quality_rules": quality.ORACLE_OP3,
    "op4_line_dedup": lines.ORACLE_OP4,
    "op7_url_filters": urls.ORACLE_OP7,
    "op11_ranked_search": search.ORACLE_OP11,
    "op12_secret_scan": credentials.ORACLE_OP12,
    "op13_hard_negatives": negatives.ORACLE_OP13,
}
