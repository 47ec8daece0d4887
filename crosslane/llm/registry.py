"""The queries of the training-data operators and their DuckDB counterparts."""

from __future__ import annotations

from . import bpe, chat, decontamination, exact_dedup, jaccard_join, licenses, merkle, mixing, prefix_trie, secrets, toxicity, vector_search, warc
from .work import shipped

MODULES = (bpe, toxicity, jaccard_join, licenses, vector_search, exact_dedup, warc, chat, mixing, secrets, merkle, prefix_trie, decontamination)
QUERIES = {name: shipped(f) for m in MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql() if callable(sql) else sql for m in MODULES for name, sql in m.ORACLE.items()}
