"""The queries of this subpackage and the SQL that says the same."""

from __future__ import annotations

from eventweave.llm import centroids, decontaminate, hard_negatives, jaccard_join, line_dedup, mixing, neighbours, quality, simhash, substring_dedup, token_counts, token_files, toxicity


def queries() -> dict:
    return {
        "op1_substring_dedup": substring_dedup.op1_substring_dedup,
        "op10_line_dedup": line_dedup.op10_line_dedup,
        "op11_ngram_jaccard_join": jaccard_join.op11_ngram_jaccard_join,
        "op12_centroid_clustering": centroids.op12_centroid_clustering,
        "op13_hard_negatives": hard_negatives.op13_hard_negatives,
        "op2_simhash_near_dedup": simhash.op2_simhash_near_dedup,
        "op3_token_files": token_files.op3_token_files,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_source_mixing": mixing.op5_source_mixing,
        "op6_quality_resampling": quality.op6_quality_resampling,
        "op7_nearest_neighbours": neighbours.op7_nearest_neighbours,
        "op8_token_counts": token_counts.op8_token_counts,
        "op9_benchmark_decontamination": decontaminate.op9_benchmark_decontamination,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op9_benchmark_decontamination": decontaminate.ORACLE,
        "op10_line_dedup": line_dedup.ORACLE,
        "op11_ngram_jaccard_join": jaccard_join.op11_ngram_jaccard_join,
        "op12_centroid_clustering": centroids.ORACLE,
        "op13_hard_negatives": hard_negatives.ORACLE,
    }
