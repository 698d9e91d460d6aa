"""The queries of this package by name, and the SQL that some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import centroids, decontaminate, exact_dedup, html_text, jaccard_join, near_dedup, packing, quality, ranked_search, substrings, tokens, toxicity, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        html_text.op1_html_text,
        quality.op2_quality,
        tokens.op3_token_counts,
        url_filter.op4_url_filter,
        near_dedup.op5_near_duplicates,
        toxicity.op6_toxicity,
        exact_dedup.op7_exact_dedup,
        packing.op8_packing,
        decontaminate.op9_decontaminate,
        substrings.op10_substring_dedup,
        ranked_search.op11_ranked_search,
        centroids.op12_centroid_clusters,
        jaccard_join.op13_jaccard_components,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op7_exact_dedup": exact_dedup.OP7_SQL,
    "op11_ranked_search": ranked_search.OP11_SQL,
    "op12_centroid_clusters": centroids.OP12_SQL,
    "op13_jaccard_components": jaccard_join.OP13_SQL,
}
