"""Query of operator 8; a brute-force version of the counts stands in for SQL."""

from __future__ import annotations

from mailloom.llm.common import table
from mailloom.llm.rules import judged


def op8_quality_rules(spark, sf_dir):
    """Counts of every document and whether it is kept."""
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op8_quality_rules": (op8_quality_rules, None)}
