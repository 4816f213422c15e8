"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from tabscore.llm import chat, decontaminate, language_crf, license_scan, line_dedup, near_documents, page_text, prefix_trie, quality_ftrl, sentencepiece_codec, token_alignment, token_files, vector_join

MODULES = [page_text, chat, line_dedup, near_documents, decontaminate, language_crf, vector_join, license_scan, sentencepiece_codec, token_files,
           quality_ftrl, token_alignment, prefix_trie]
QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in getattr(m, "ORACLE", {}).items()}
