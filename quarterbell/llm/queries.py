"""The queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarterbell.llm import alignment, decontamination, embeddings, licenses, mixing, nearduplicates, private, scoring, sharding, spelling, substrings, suffixes, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": licenses.op1_license_scan,
        "op2_remove_repeats": substrings.op2_remove_repeats,
        "op3_private_data": private.op3_private_data,
        "op4_near_duplicates": nearduplicates.op4_near_duplicates,
        "op5_near_vectors": embeddings.op5_near_vectors,
        "op6_decontamination": decontamination.op6_decontamination,
        "op7_mix_sources": mixing.op7_mix_sources,
        "op8_language_model_scores": scoring.op8_language_model_scores,
        "op9_shard_documents": sharding.op9_shard_documents,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_align_tokenizers": alignment.op11_align_tokenizers,
        "op12_spelling_variants": spelling.op12_spelling_variants,
        "op13_suffix_dedup": suffixes.op13_suffix_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_mix_sources": mixing.OP7_SQL}
