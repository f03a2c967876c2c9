"""Corpus operators for training-data work, and their registered queries."""

from . import (decontaminate, filter_audit, fingerprint, html_extract, mixing, quality, shingle_join, suffix_dedup, token_count,
               tool_chat, topk_search, toxicity, vector_codes)

QUERIES = {
    "op1_tool_chat": tool_chat.op1_tool_chat,
    "op2_quality": quality.op2_quality,
    "op5_toxicity": toxicity.op5_toxicity,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_token_count": token_count.op4_token_count,
    "op6_mixing": mixing.op6_mixing,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_html_extract": html_extract.op8_html_extract,
    "op9_shingle_join": shingle_join.op9_shingle_join,
    "op10_fingerprints": fingerprint.op10_fingerprints,
    "op11_topk_search": topk_search.op11_topk_search,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}
#: Operators over rows derived from a given table, beside those over the table itself.
DERIVED = {"op1_tool_calls": tool_chat.op1_tool_calls}
ORACLE = {"op1_tool_chat": tool_chat.ORACLE_OP1, "op7_decontaminate": decontaminate.ORACLE_OP7, "op11_topk_search": topk_search.ORACLE_OP11,
          "op12_filter_audit": filter_audit.ORACLE_OP12, "op13_vector_codes": vector_codes.ORACLE_OP13}
