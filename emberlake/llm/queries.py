"""The numbered queries, the pipeline, and the SQL they must agree with."""

from __future__ import annotations

import importlib

from emberlake.queries import Query

# Query name -> module that holds the function of that name and, where SQL can say it, ``SQL``.
MODULES = {
    "op1_near_dedup": "near_dedup",
    "op2_sentencepiece": "tokens",
    "op3_toxicity": "toxicity",
    "op4_mixing": "mixing",
    "op5_language_id": "language",
    "op6_sharding": "sharding",
    "op8_fingerprints": "fingerprints",
    "op9_neighbours": "neighbours",
    "op10_substring_dedup": "substring_dedup",
    "op7_line_dedup": "line_dedup",
    "op11_wavelet_ids": "wavelet",
    "op12_periodic_runs": "periods",
    "op13_conversation_trie": "prefixes",
}


def _query(name: str, module_name: str) -> Query:
    module = importlib.import_module(f"emberlake.llm.{module_name}")
    return Query(getattr(module, name), getattr(module, "SQL", None))


QUERIES = {name: _query(name, module) for name, module in MODULES.items()}
