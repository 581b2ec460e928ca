"""Queries of this package by registered name, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm import chat_format, decontaminate, embedding_dedup, language_id, lexical_search, line_dedup, packing, phrases, quality, secret_scan, simhash, suffix_dedup, token_counts


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_classifier": quality.op1_quality_classifier,
        "op2_simhash_near_dedup": simhash.op2_simhash_near_dedup,
        "op3_benchmark_decontamination": decontaminate.op3_benchmark_decontamination,
        "op4_best_fit_packing": packing.op4_best_fit_packing,
        "op5_language_id": language_id.op5_language_id,
        "op6_secret_scan": secret_scan.op6_secret_scan,
        "op7_line_dedup": line_dedup.op7_line_dedup,
        "op8_token_counts": token_counts.op8_token_counts,
        "op9_chat_formatting": chat_format.op9_chat_formatting,
        "op10_embedding_near_dedup": embedding_dedup.op10_embedding_near_dedup,
        "op11_ranked_lexical_search": lexical_search.op11_ranked_lexical_search,
        "op12_phrase_collocations": phrases.op12_phrase_collocations,
        "op13_suffix_array_dedup": suffix_dedup.op13_suffix_array_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_line_dedup": line_dedup.OP7_SQL, "op9_chat_formatting": chat_format.OP9_SQL,
            "op10_embedding_near_dedup": embedding_dedup.OP10_SQL, "op11_ranked_lexical_search": lexical_search.OP11_SQL,
            "op12_phrase_collocations": phrases.OP12_SQL}
