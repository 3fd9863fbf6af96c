"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import decontaminate, langid, lattice, mixing, ngram, pii, simhash, suffix_array, suffix_tree, tokencount


def queries() -> dict:
    return {
        "op1_pii": pii.op1_pii,
        "op2_language_id": langid.op2_language_id,
        "op3_lattice_near_dedup": lattice.op3_lattice_near_dedup,
        "op4_decontaminate": decontaminate.op4_decontaminate,
        "op5_simhash_near_dedup": simhash.op5_simhash_near_dedup,
        "op6_mixing": mixing.op6_mixing,
        "op7_token_counts": tokencount.op7_token_counts,
        "op8_suffix_array_dedup": suffix_array.op8_suffix_array_dedup,
        "op9_substring_dedup": suffix_tree.op9_substring_dedup,
        "op10_ngram_score": ngram.op10_ngram_score,
        "pii_base_spans": pii.pii_base_spans,
        "ngram_base_score": ngram.ngram_base_score,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_lattice_near_dedup": lattice.ORACLE, "op6_mixing": mixing.ORACLE, "op8_suffix_array_dedup": suffix_array.ORACLE, "op9_substring_dedup": suffix_tree.ORACLE, "pii_base_spans": pii.ORACLE, "ngram_base_score": ngram.ORACLE}
