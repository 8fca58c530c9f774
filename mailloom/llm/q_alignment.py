"""Query of operator 12; tests stand in for SQL, which has no tokenizers."""

from __future__ import annotations

from mailloom.llm.alignment import align
from mailloom.llm.common import table


def op12_token_alignment(spark, sf_dir):
    """Tokens of two tokenizers over all documents, where they end together, and how often."""
    return align(table(spark, sf_dir, "documents"))


QUERIES = {"op12_token_alignment": (op12_token_alignment, None)}
