"""Changes to a mailbox, as new snapshots of its message table.

Only the columns ``folder``, ``uid`` and ``flags`` are needed: at scale, keep
the flags in a narrow table of their own and leave the content where it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.functions.text import flags_or_empty, has_flag
from mailloom.operators.joins import (
    BROADCAST_BYTES,
    lookup_join,
    materialise,
    measured_bytes,
)


def _add_flag(df: DataFrame, done: DataFrame, flag: str, computed: bool) -> DataFrame:
    keys = done.filter(F.col("uid") > 0).select("folder", "uid").distinct()
    marked = lookup_join(
        df, keys.withColumn("_done", F.lit(True)), ["folder", "uid"], computed=computed
    )
    flags = flags_or_empty(F.col("flags"))
    return marked.withColumn(
        "flags", F.when(F.col("_done"), F.array_union(flags, F.array(F.lit(flag))))
        .otherwise(F.col("flags")),
    ).drop("_done")


def mark_read(df: DataFrame, done: DataFrame, computed: bool = True) -> DataFrame:
    """Messages with SEEN added to every one in ``done``."""
    return _add_flag(df, done, "SEEN", computed)


def flag_deleted(df: DataFrame, done: DataFrame, computed: bool = True) -> DataFrame:
    """Messages with DELETED added to every one in ``done``."""
    return _add_flag(df, done, "DELETED", computed)


def expunge(df: DataFrame, done: DataFrame, computed: bool = True) -> DataFrame:
    """Remove all messages flagged DELETED from folders with something in ``done``."""
    touched = done.filter(F.col("uid") > 0).select("folder").distinct()
    return lookup_join(
        df, touched, ["folder"], "left_anti", spread=["uid"],
        condition=has_flag(F.col("flags"), "DELETED"), computed=computed,
    )


def with_marks(
    df: DataFrame, marks: DataFrame, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The mailbox as a log of marks leaves it: flags added, deleted messages gone.

    ``marks`` are narrow rows (``folder``, ``uid``, ``read``, ``deleted``) and are
    measured before they are joined. Beyond ``max_bytes`` they are shuffled to the
    messages, as in ``resolve``: give a table of ``save_messages`` in ``df``, or envelopes.
    """
    marks = materialise(marks.groupBy("folder", "uid").agg(
        F.max("read").alias("_read"), F.max("deleted").alias("_gone")
    ))
    joined = _by_key(df, marks, "left", max_bytes)
    flags = flags_or_empty(F.col("flags"))
    seen = F.when(F.col("_read"), F.array_union(flags, F.array(F.lit("SEEN"))))
    left = joined.withColumn("flags", F.coalesce(seen, F.col("flags"))).filter(
        ~F.coalesce("_gone", F.lit(False))
    ).drop("_read", "_gone")
    # Where messages were deleted, all that carried the flag went with them.
    touched = marks.filter("_gone").select("folder").distinct()
    return lookup_join(
        left, touched, ["folder"], "left_anti", spread=["uid"],
        condition=has_flag(F.col("flags"), "DELETED"),
    )


def resolve(ids: DataFrame, df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Messages by folder and UID; ids that no longer exist drop out silently.

    Up to ``max_bytes`` of ids are broadcast. Beyond that the ids are shuffled to where the
    messages lie and looked up there by hash: in a table of ``save_messages``, which is
    bucketed by folder and UID, no message moves and none is sorted. Messages of other
    tables are shuffled with their content.
    """
    keys = materialise(ids.select("folder", "uid").distinct())
    return _by_key(df, keys, "inner", max_bytes)


def _by_key(df: DataFrame, keys: DataFrame, how: str, max_bytes: int) -> DataFrame:
    """Join messages to rows of unique keys; by hash, so that no message is sorted."""
    size = measured_bytes(keys)
    if size > max_bytes:
        keys = keys.hint("shuffle_hash")
    return lookup_join(df, keys, ["folder", "uid"], how, max_bytes=max_bytes, known_bytes=size)
