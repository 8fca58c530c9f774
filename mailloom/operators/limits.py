"""The per-run cap of each folder, and batches.

Places are found by counting: messages per folder and range of ids, the range where the cap
falls, and ranks in that range only. No task ever sees a whole folder, however large the cap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailloom.operators.cursor import id_column
from mailloom.operators.joins import lookup_join
from mailloom.schema import FetchOptions

#: Ids that are counted together. UIDs have 32 bits, so a folder has at most 2^19 ranges.
RANGE = 1 << 13


def id_range(ident: Column) -> Column:
    return F.floor(ident / F.lit(RANGE)).cast("long")


def mailbox_id(df: DataFrame) -> Column:
    """The id a message is placed by; one without any comes first."""
    return F.coalesce(id_column(df), F.lit(0)).cast("long")


def ranges_of(counts: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, _range, _n)`` rows with ``_before``: how many of a group lie in earlier ranges."""
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))


def id_ranges(ids: DataFrame, by: list[str]) -> DataFrame:
    """Rows of each group per range of ids, and before it: sums, made before any shuffle."""
    counts = ids.groupBy(*by, id_range(F.col("_id")).alias("_range"))
    return ranges_of(counts.agg(F.count(F.lit(1)).alias("_n")), by)


def falls_in(ranges: DataFrame) -> DataFrame:
    """Of ranges with a ``_cap`` those where it falls."""
    return ranges.filter(
        (F.col("_before") < F.col("_cap")) & (F.col("_cap") <= F.col("_before") + F.col("_n"))
    ).drop("_n")


def cut_ids(inside: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, _cap, _cap_id)`` from the ``_id`` of all rows in the range where a cap falls.

    Rows are counted per id first, so that at most ``RANGE`` counts of a group and cap meet.
    """
    counts = inside.groupBy(*by, "_cap", "_before", "_id").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*by, "_cap").orderBy("_id"))
    return counts.withColumn("_upto", F.col("_before") + upto).filter(
        F.col("_upto") >= F.col("_cap")
    ).groupBy(*by, "_cap").agg(F.min("_id").alias("_cap_id"))


def cap_per_folder(df: DataFrame, batch_size: int, succeeded: Column) -> DataFrame:
    """Messages a run reaches before it has ``10 * batch_size`` successes per folder.

    Failing messages met on the way stay in and are not counted; nothing after
    the last counted success does. A batch has to hold at least one message.
    """
    if batch_size <= 0:
        raise ValueError("the batch size has to be positive")
    cap = batch_size * FetchOptions.BATCHES_PER_RUN
    ids = df.filter(succeeded).select("folder", mailbox_id(df).alias("_id"))
    falls = falls_in(id_ranges(ids, ["folder"]).withColumn("_cap", F.lit(cap)))
    # The key of this join holds the range, so no folder is one key of it.
    inside = lookup_join(
        ids.withColumn("_range", id_range(F.col("_id"))), falls, ["folder", "_range"], "inner",
        computed=True,
    )
    last = cut_ids(inside, ["folder"]).select("folder", "_cap_id")
    ident = [name for name in ("uid", "msg_num") if name in df.columns]
    joined = lookup_join(df, last, ["folder"], spread=ident, computed=True)
    return joined.filter(
        F.col("_cap_id").isNull() | (mailbox_id(df) <= F.col("_cap_id"))
    ).drop("_cap_id")


def batch_number(df: DataFrame, batch_size: int, succeeded: Column) -> DataFrame:
    """Successes of a capped run with the number of their batch, from 0.

    A message's place is its place in its range of ids after all that lie in earlier ones.
    """
    ids = df.filter(succeeded).select("folder", mailbox_id(df).alias("_id"))
    starts = id_ranges(ids, ["folder"]).drop("_n")
    capped = cap_per_folder(df, batch_size, succeeded).filter(succeeded)
    placed = capped.withColumn("_range", id_range(mailbox_id(df))).join(
        starts, ["folder", "_range"]
    )
    window = Window.partitionBy("folder", "_range").orderBy(mailbox_id(df))
    place = F.col("_before") + F.row_number().over(window) - 1
    return placed.withColumn("batch_number", F.floor(place / batch_size)).drop("_range", "_before")
