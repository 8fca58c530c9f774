"""Query of operator 5; held-out accuracy stands in for SQL."""

from __future__ import annotations

from mailloom.llm.common import table
from mailloom.llm.toxicity import scored


def op5_viterbi_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op5_viterbi_toxicity": (op5_viterbi_toxicity, None)}
