"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corate.llm import chat, decontaminate, jaccard_join, licenses, line_dedup, merkle, mixing, pii, quality, site_tree, suffix_dedup, url_filter, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": quality.query,
    "op2_chat_formatting": chat.query,
    "op3_html_extraction": site_tree.query,
    "op4_line_dedup": line_dedup.query,
    "op5_pii": pii.query,
    "op6_decontamination": decontaminate.query,
    "op7_mixing": mixing.query,
    "op8_license_scan": licenses.query,
    "op9_suffix_dedup": suffix_dedup.query,
    "op10_jaccard_join": jaccard_join.query,
    "op11_url_filter": url_filter.query,
    "op12_embedding_whitening": whitening.query,
    "op13_merkle_manifest": merkle.query,
}

ORACLE: dict[str, str] = {
    "op1_quality_rules": quality.SQL,
    "op2_chat_formatting": chat.SQL,
    "op4_line_dedup": line_dedup.SQL,
    "op7_mixing": mixing.SQL,
    "op8_license_scan": licenses.SQL,
    "op11_url_filter": url_filter.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
