"""The numbered queries with their SQL twins, gathered from the operators' modules."""

from __future__ import annotations

from tidemark.llm import bpe, chat, decontaminate, divergence, jaccard, language, lines, lm, quality, rules, secrets, tokenfiles, whitening

_MODULES = (language, rules, lines, decontaminate, jaccard, quality, secrets, chat, bpe, lm, divergence, tokenfiles, whitening)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: text for module in _MODULES for name, text in module.SQL.items()}
