"""Connected components of a graph of numbered nodes, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.llm.common import remove, scratch, stored


def components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the least node reachable.

    Rounds of two steps: every node links its larger neighbours to its least
    neighbour, then its smaller ones. The rounds end when the links no longer change;
    they then are stars around the roots. A hub's links are summed up before they are
    shuffled, and no node's links are gathered in one row. Each round is written to the
    shared folder, and the round before is removed.
    """
    spark = edges.sparkSession
    folder = folder or scratch(spark)
    links = stored(
        edges.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct(),
        f"{folder}/links-0",
    )
    before, n = _mark(links), 0
    while before[0]:
        n += 1
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            links.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a")
            .where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        lower = large.join(least, "a").where("b <> m").select(
            F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")
        )
        new = stored(
            lower.unionByName(least.withColumnRenamed("m", "b")).distinct(),
            f"{folder}/links-{n}",
        )
        now = _mark(new)
        remove(spark, f"{folder}/links-{n - 1}")
        links = new
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _mark(links: DataFrame) -> tuple[int, int]:
    """Number of links and a sum of their hashes: equal marks mean equal links."""
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_000_007), F.lit(0)).alias("h"),
    ).first()
    return row["n"], row["h"]
