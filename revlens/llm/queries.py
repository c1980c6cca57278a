"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from . import (centroid_clustering, embedding_dedup, exact_dedup, importance_resampling, jaccard_join, license_scan, line_dedup,
               mixing, packing, secret_scan, topk_search, toxicity, url_filter)

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_mixing": mixing.op4_mixing,
    "op5_embedding_dedup": embedding_dedup.op5_embedding_dedup,
    "op6_packing": packing.op6_packing,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_secrets": secret_scan.op8_secrets,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_centroid_clustering": centroid_clustering.op11_centroid_clustering,
    "op12_importance_resampling": importance_resampling.op12_importance_resampling,
    "op13_topk_search": topk_search.op13_topk_search,
}

SQL = {
    "op1_license_scan": license_scan.SQL,
    "op4_mixing": mixing.SQL,
    "op7_url_filter": url_filter.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op11_centroid_clustering": centroid_clustering.SQL,
    "op12_importance_resampling": importance_resampling.SQL,
    "op13_topk_search": topk_search.SQL,
}
