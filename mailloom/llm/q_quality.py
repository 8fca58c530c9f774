"""Query of operator 6; held-out accuracy stands in for SQL."""

from __future__ import annotations

from mailloom.llm.common import table
from mailloom.llm.quality import scored


def op6_ftrl_quality(spark, sf_dir):
    """Quality score of every document."""
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op6_ftrl_quality": (op6_ftrl_quality, None)}
