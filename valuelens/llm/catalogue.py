"""The queries of this package: importing it registers them all."""

from __future__ import annotations

from valuelens.llm import q_models, q_negatives, q_pairs, q_tables, q_text, q_tokens, q_trie  # noqa: F401
from valuelens.llm.tables import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
