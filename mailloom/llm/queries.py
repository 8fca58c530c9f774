"""The queries on training text over the given tables, and their SQL for DuckDB."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Modules with ``QUERIES``: name -> (query, SQL or None).
MODULES = (
    "q_mixing", "q_suffix", "q_simhash", "q_chat", "q_toxicity", "q_quality", "q_html",
    "q_rules", "q_contamination", "q_seed", "q_packing", "q_alignment", "q_manifest",
)


def _entries() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    found: dict = {}
    for name in MODULES:
        found |= importlib.import_module(f"mailloom.llm.{name}").QUERIES
    import corpus_pipeline

    found["pipeline"] = (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for name, (run, _) in _entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _entries().items() if sql}
