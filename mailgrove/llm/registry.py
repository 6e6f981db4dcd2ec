"""The operators' queries and their DuckDB oracles."""

from __future__ import annotations

import corpus_pipeline
from mailgrove.llm import ann, bpe, langid, licenses, linededup, packing, simhash, tokenstore, toxicity, vecdedup

MODULES = (langid, simhash, toxicity, linededup, ann, licenses, bpe, tokenstore, vecdedup, packing)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {name: sql for m in MODULES for name, sql in getattr(m, "ORACLES", {}).items()} | pipeline
