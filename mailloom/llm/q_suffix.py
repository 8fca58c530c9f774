"""Query of operator 2; a brute-force version stands in for SQL."""

from __future__ import annotations

from mailloom.llm.common import table
from mailloom.llm.suffix_dedup import removals


def op2_suffix_dedup(spark, sf_dir):
    """What remains of every document without byte strings that repeat."""
    return removals(table(spark, sf_dir, "documents"))


QUERIES = {"op2_suffix_dedup": (op2_suffix_dedup, None)}
