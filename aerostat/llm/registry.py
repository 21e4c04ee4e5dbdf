"""Queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from aerostat.llm import (bytepairs, chat, exact_dedup, html_extract, knn_join, langid, licenses, packing, part_codes,
                          sentencepieces, shared_search, similarity_join, warc)

QUERIES = {
    "op1_pack_documents": packing.op1_pack_documents,
    "op2_extract_text": html_extract.op2_extract_text,
    "op3_similarity_join": similarity_join.op3_similarity_join,
    "op4_tool_calls": chat.op4_tool_calls,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_warc": warc.op6_warc,
    "op7_sentencepiece": sentencepieces.op7_sentencepiece,
    "op8_language_id": langid.op8_language_id,
    "op9_top_k": knn_join.op9_top_k,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_part_codes": part_codes.op11_part_codes,
    "op12_shared_search": shared_search.op12_shared_search,
    "op13_byte_pairs": bytepairs.op13_byte_pairs,
}

ORACLE = {
    "op4_tool_calls": chat.OP4_SQL,
    "op6_warc": warc.OP6_SQL,
    "op9_top_k": knn_join.OP9_SQL,
    "op10_exact_dedup": exact_dedup.OP10_SQL,
    "op11_part_codes": part_codes.OP11_SQL,
    "op12_shared_search": shared_search.OP12_SQL,
}
