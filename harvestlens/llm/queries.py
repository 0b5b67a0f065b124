"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from . import (best_fit_packing, collocations, conversation_trie, decontamination, hilbert_sharding,
               language_id, lattice_lm, licence_scan, line_dedup, pq_dedup, probminhash_dedup, substring_dedup,
               toxicity)


def register(queries: dict, sql: dict) -> None:
    queries["op1_line_dedup"] = line_dedup.op1_line_dedup
    sql["op1_line_dedup"] = line_dedup.ORACLE
    queries["op2_best_fit_packing"] = best_fit_packing.op2_best_fit_packing
    queries["op3_pq_dedup"] = pq_dedup.op3_pq_dedup
    queries["op4_probminhash_dedup"] = probminhash_dedup.op4_probminhash_dedup
    queries["op5_language_id"] = language_id.op5_language_id
    queries["op6_lattice_lm"] = lattice_lm.op6_lattice_lm
    queries["op7_decontamination"] = decontamination.op7_decontamination
    sql["op7_decontamination"] = decontamination.ORACLE
    queries["op8_prefix_free_dedup"] = substring_dedup.op8_prefix_free_dedup
    queries["op9_licence_scan"] = licence_scan.op9_licence_scan
    queries["op10_hilbert_sharding"] = hilbert_sharding.op10_hilbert_sharding
    queries["op11_toxicity"] = toxicity.op11_toxicity
    queries["op12_conversation_trie"] = conversation_trie.op12_conversation_trie
    sql["op12_conversation_trie"] = conversation_trie.ORACLE
    queries["op13_collocations"] = collocations.op13_collocations
    sql["op13_collocations"] = collocations.ORACLE
