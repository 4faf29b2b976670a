"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meridian.llm import centroids, decontamination, exact_dedup, language_id, licenses, merkle, near_join, packing, pii, quality, secret_scan, token_files, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontamination.query,
    "op2_exact_dedup": exact_dedup.query,
    "op3_toxicity": toxicity.query,
    "op4_ngram_jaccard_join": near_join.query,
    "op5_license_scan": licenses.query,
    "op6_pii": pii.query,
    "op7_token_files": token_files.query,
    "op8_quality_classifier": quality.query,
    "op9_secret_scan": secret_scan.query,
    "op10_best_fit_packing": packing.query,
    "op11_merkle_manifest": merkle.query,
    "op12_language_id": language_id.query,
    "op13_centroid_clustering": centroids.query,
}

SQL: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op4_ngram_jaccard_join": near_join.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op13_centroid_clustering": centroids.SQL,
}
