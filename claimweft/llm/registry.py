"""Queries of the corpus operators and their SQL."""

from __future__ import annotations

from claimweft.llm import fingerprints, language, licenses, line_dedup, media, mixing, near_dedup, packing, secrets, suffix_dedup


def queries():
    return {
        "op1_best_fit_packing": packing.op1_best_fit_packing,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op3_license_scan": licenses.op3_license_scan,
        "op4_suffix_array_dedup": suffix_dedup.op4_suffix_array_dedup,
        "op5_source_mixing": mixing.op5_source_mixing,
        "op6_minhash_near_dedup": near_dedup.op6_minhash_near_dedup,
        "op7_document_fingerprints": fingerprints.op7_document_fingerprints,
        "op8_media_columns": media.op8_media_columns,
        "op9_secret_scan": secrets.op9_secret_scan,
        "op10_language_id": language.op10_language_id,
    }


def oracle_sql():
    return {"op2_line_dedup": line_dedup.ORACLE, "op3_license_scan": licenses.oracle(), "op9_secret_scan": secrets.oracle()}
