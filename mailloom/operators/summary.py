"""Counts of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_summary(candidates: DataFrame) -> DataFrame:
    """Messages per folder and, with a NULL folder, in total.

    Candidates are the messages after search and cursor, before cap and errors.
    An empty run still has its total row, with ``had_messages`` false.
    """
    per_folder = candidates.groupBy("folder").agg(F.count(F.lit(1)).alias("processed"))
    total = per_folder.agg(
        F.lit(None).cast("string").alias("folder"),
        F.coalesce(F.sum("processed"), F.lit(0)).alias("processed"),
    )
    return per_folder.unionByName(total).withColumn("had_messages", F.col("processed") > 0)
