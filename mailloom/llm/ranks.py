"""Places of rows within their groups, without a task that holds a whole group.

Rows are dealt out by ranges of group and order, so a group that holds a third of all
rows spreads over many tasks. Each task numbers its own rows; how many rows of a group
come before a task is a sum over one row per task and group.

A null in ``order`` comes first. Rows that agree in all ``order`` columns get places next
to each other, in any order; give a column that tells them apart where that matters, and
as many rows as agree in all of them meet in one task. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailloom.llm.common import stored
from mailloom.operators.joins import lookup_join

#: Rows that one task sorts; more tasks are taken than Spark's setting where that is too few.
ROWS_A_TASK = 1_000_000


def ranked(rows: DataFrame, group: str, order: list[str], rows_a_task: int = ROWS_A_TASK):
    """``rows`` with ``rank`` (from 0) and ``size`` of their group.

    ``rows`` should be a written table: it is counted, sampled for the ranges and read.
    ``group`` is never null. The names ``rank``, ``size``, ``_at`` and ``_part`` are new.
    """
    setting = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(setting, -(-rows.count() // rows_a_task))
    # The id holds the task's number above 33 bits with the row's place in the task; it is
    # written, so a task that runs again changes nothing.
    dealt = stored(
        rows.repartitionByRange(tasks, group, *order).sortWithinPartitions(group, *order)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", 33))
    runs = dealt.groupBy(group, "_part").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(runs.select(
        group, "_part", F.sum("_rows").over(whole).alias("size"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    ))
    found = lookup_join(dealt, starts, [group, "_part"], spread=["_at"])
    return found.withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")
