"""Queries of the training-data operators, one per operator, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from ..session import ensure_checkpoint_dir, ship_package
from . import (chat, fingerprints, language_id, line_dedup, merkle, mixing, near_dedup, passage_dedup, pii, piece_codec, resampling,
               token_files, top_k)

QUERIES = {
    "op1_pii_weak_labels": pii.query,
    "op2_piece_codec": piece_codec.query,
    "op3_language_id": language_id.query,
    "op4_token_files": token_files.query,
    "op5_source_mixing": mixing.query,
    "op6_passage_dedup": passage_dedup.query,
    "op7_superminhash_groups": near_dedup.query,
    "op8_minhash_fingerprints": fingerprints.query,
    "op9_norm_sorted_top_k": top_k.query,
    "op10_line_dedup": line_dedup.query,
    "op11_importance_resampling": resampling.query,
    "op12_chat_parts": chat.query,
    "op13_merkle_manifest": merkle.query,
    "pipeline": corpus_pipeline.run,
}
ORACLE = {
    "op5_source_mixing": mixing.ORACLE,
    "op9_norm_sorted_top_k": top_k.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op12_chat_parts": chat.ORACLE,
}


def _wrap(fn):
    def run(spark, sf_dir):
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return fn(spark, sf_dir)
    return run


def queries():
    return {k: _wrap(v) for k, v in QUERIES.items()}


def oracle_sql():
    return dict(ORACLE) | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
