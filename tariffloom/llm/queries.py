"""The registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

import importlib

_MODULES = ["packing", "quality", "jaccard", "embed_dedup", "secrets", "exact_topk", "substring", "toxicity", "bpe", "lm_score"]

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
for _name in _MODULES:
    _m = importlib.import_module(f"tariffloom.llm.{_name}")
    QUERIES |= _m.QUERIES
    ORACLE |= getattr(_m, "ORACLE", {})
