"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from . import bpe, decontamination, exact_dedup, language_id, simhash, substring_dedup, suffix_array, token_ids, toxicity, warc


def queries() -> dict:
    return {
        "op1_exact_dedup": exact_dedup.op1_exact_dedup,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_bpe": bpe.op3_bpe,
        "op4_suffix_array": suffix_array.op4_suffix_array,
        "op5_language_id": language_id.op5_language_id,
        "op6_warc": warc.op6_warc,
        "op7_simhash": simhash.op7_simhash,
        "op8_decontamination": decontamination.op8_decontamination,
        "op9_substring_dedup": substring_dedup.op9_substring_dedup,
        "op10_token_ids": token_ids.op10_token_ids,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": exact_dedup.OP1_SQL,
        "op4_suffix_array": suffix_array.OP4_SQL,
        "op6_warc": warc.OP6_SQL,
        "op8_decontamination": decontamination.OP8_SQL,
        "op9_substring_dedup": substring_dedup.OP9_SQL,
    }
