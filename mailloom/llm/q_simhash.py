"""Query of operator 3; a brute-force version stands in for SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailloom.llm.common import table
from mailloom.llm.simhash import near_duplicates


def op3_simhash_groups(spark, sf_dir):
    """Fingerprint and group of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


QUERIES = {"op3_simhash_groups": (op3_simhash_groups, None)}
