"""Registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from farelake.llm import (
    licenses,
    merkle,
    metric_join,
    mixing,
    oracles,
    personal_data,
    pieces,
    quality,
    ranked_search,
    secrets,
    sharding,
    simhash,
    spotsigs,
    templates,
)


def queries() -> dict:
    """Query name → ``(spark, sf_dir) -> DataFrame``."""
    return {
        "op1_spotsigs": spotsigs.query,
        "op2_log_templates": templates.query,
        "op3_metric_range_join": metric_join.query,
        "op4_license_scan": licenses.query,
        "op5_quality_bayes": quality.query,
        "op6_rendezvous_sharding": sharding.query,
        "op7_mixture_blocks": mixing.query,
        "op8_simhash_tiles": simhash.query,
        "op9_piece_codec": pieces.query,
        "op10_secret_scan": secrets.query,
        "op11_ranked_search": ranked_search.query,
        "op12_skip_chain_pii": personal_data.query,
        "op13_merkle_manifest": merkle.query,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return oracles.oracle_sql()
