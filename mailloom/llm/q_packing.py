"""Query of operator 11; tests stand in for SQL, which has no tokenizer."""

from __future__ import annotations

from mailloom.llm.common import table
from mailloom.llm.packing import pack


def op11_slack_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op11_slack_packing": (op11_slack_packing, None)}
