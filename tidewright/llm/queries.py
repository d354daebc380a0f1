"""Queries of the training-data operators and their SQL where there is one."""

from __future__ import annotations

from . import op01_chat, op02_packing, op03_token_counts, op04_language_id, op05_pii, op06_exact_dedup, op07_mixing, op08_sharding, op09_jaccard_join, op10_embedding_dedup

QUERIES = {
    "op1_chat_format": op01_chat.query,
    "op2_packing": op02_packing.query,
    "op3_token_counts": op03_token_counts.query,
    "op4_language_id": op04_language_id.query,
    "op5_pii": op05_pii.query,
    "op6_exact_dedup": op06_exact_dedup.query,
    "op7_mixing": op07_mixing.query,
    "op8_sharding": op08_sharding.query,
    "op9_jaccard_join": op09_jaccard_join.query,
    "op10_embedding_dedup": op10_embedding_dedup.query,
}
SQL = {
    "op1_chat_format": op01_chat.SQL,
    "op6_exact_dedup": op06_exact_dedup.SQL,
    "op9_jaccard_join": op09_jaccard_join.SQL,
    "op10_embedding_dedup": op10_embedding_dedup.SQL,
}
