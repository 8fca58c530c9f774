"""Query of operator 7; pages with a known main text stand in for SQL."""

from __future__ import annotations

from mailloom.llm.common import table
from mailloom.llm.html import extracted


def op7_html_regions(spark, sf_dir):
    """Main text of every page."""
    return extracted(table(spark, sf_dir, "pages"))


QUERIES = {"op7_html_regions": (op7_html_regions, None)}
