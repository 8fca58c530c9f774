"""Query of operator 10; a brute-force version stands in for SQL."""

from __future__ import annotations

from mailloom.llm.common import table
from mailloom.llm.seed_extend import removals


def op10_seed_extend(spark, sf_dir):
    """What remains of every document without passages that repeat."""
    return removals(table(spark, sf_dir, "documents")).drop("kept")


QUERIES = {"op10_seed_extend": (op10_seed_extend, None)}
