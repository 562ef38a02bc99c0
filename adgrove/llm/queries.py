"""Registered queries of the training-data operators: name -> (callable, DuckDB SQL or None)."""

from __future__ import annotations

from adgrove.llm import (
    alignment, decontaminate, langid, licenses, neardup, packing, pieces, substrings, tokens, topk, toxicity, warc, whitening,
)

QUERIES = {
    "op9_sentencepiece": (pieces.query, None),
    "op4_license_notices": (licenses.query, licenses.SQL),
    "op1_benchmark_passages": (decontaminate.query, None),
    "op8_repeated_passages": (substrings.query, None),
    "op7_near_duplicates": (neardup.query, None),
    "op6_exact_top_k": (topk.query, topk.SQL),
    "op5_toxicity_cnn": (toxicity.query, None),
    "op2_token_codes": (tokens.query, None),
    "op3_arc_to_warc": (warc.query, warc.SQL),
    "op10_language_id": (langid.query, None),
    "op11_spectrum_whitening": (whitening.query, None),
    "op12_best_fit_packing": (packing.query, None),
    "op13_token_alignment": (alignment.query, None),
}
