"""Query registry of the training-data operators: one ``opN_<name>`` for each, over its whole table."""

from __future__ import annotations

from . import centroids, chat_format, filter_audit, html_extract, language_id, media_columns, mixing, packing, quality_rules, secret_scan, simhash_dedup, token_counts, toxicity
from .common import table

QUERIES = {
    "op1_simhash_dedup": lambda spark, d: simhash_dedup.query(table(spark, d, "documents")),
    "op2_html_extract": lambda spark, d: html_extract.query(table(spark, d, "pages")),
    "op3_chat_format": lambda spark, d: chat_format.query(table(spark, d, "conversations")),
    "op4_secret_scan": lambda spark, d: secret_scan.query(table(spark, d, "documents")),
    "op5_language_id": lambda spark, d: language_id.query(table(spark, d, "documents")),
    "op6_quality_rules": lambda spark, d: quality_rules.query(table(spark, d, "documents"), table(spark, d, "labels")),
    "op7_media_columns": lambda spark, d: media_columns.query(table(spark, d, "documents")),
    "op8_toxicity": lambda spark, d: toxicity.query(table(spark, d, "documents"), table(spark, d, "labels")),
    "op9_best_fit_packing": lambda spark, d: packing.query(table(spark, d, "documents")),
    "op10_mixing": lambda spark, d: mixing.query(table(spark, d, "documents")),
    "op11_token_counts": lambda spark, d: token_counts.query(table(spark, d, "documents")),
    "op12_filter_audit": lambda spark, d: filter_audit.query(table(spark, d, "documents"), table(spark, d, "labels")),
    "op13_centroids": lambda spark, d: centroids.query(table(spark, d, "embeddings")),
}

ORACLE_SQL: dict[str, str] = {
    "op3_chat_format": chat_format.ORACLE_SQL,
    "op10_mixing": mixing.ORACLE_SQL,
    "op12_filter_audit": filter_audit.ORACLE_SQL,
    "op13_centroids": centroids.ORACLE_SQL,
}
