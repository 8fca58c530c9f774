"""Per-folder cursors: the highest UID that was delivered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.functions.text import state_key
from mailloom.operators.joins import lookup_join


def effective_id() -> Column:
    """The UID, or the message number where there is no UID."""
    return F.when(F.col("uid") > 0, F.col("uid")).otherwise(F.col("msg_num"))


def id_column(df: DataFrame) -> Column:
    """``effective_id`` for tables with and without message numbers."""
    return effective_id() if "msg_num" in df.columns else F.col("uid")


def above(df: DataFrame, last) -> Column:
    """True if the effective id is above ``last``, as plain comparisons.

    ``last`` is not negative, so a UID above it is a real one.
    """
    by_uid = F.col("uid") > last
    if "msg_num" not in df.columns:
        return by_uid
    no_uid = F.col("uid").isNull() | (F.col("uid") <= 0)
    return by_uid | (no_uid & (F.col("msg_num") > last))


def bytes_column(df: DataFrame) -> Column:
    """What a message weighs in a shuffle: its size, or one where no content goes along."""
    if "content" in df.columns and "size" in df.columns:
        return F.coalesce(F.greatest(F.col("size"), F.lit(0)), F.lit(0)) + 1
    return F.lit(1)


def load_cursors(stored: DataFrame) -> DataFrame:
    """Cursors from stored text values; a value that is not a number is no cursor."""
    value = F.trim(F.col("last_uid").cast("string")).try_cast("bigint")
    return stored.select("state_folder", "folder", value.alias("last_uid")).filter(
        F.col("last_uid") >= 0
    )


def after_cursor(
    df: DataFrame,
    cursors: DataFrame | dict[str, int],
    state_folder: str | None = None,
    incremental: bool = True,
) -> DataFrame:
    """Messages above the cursor of their folder; folders without one keep all.

    Cursors of a handful of folders can be given as a dict: the test then
    becomes plain comparisons that reach the Parquet scan. A table of cursors
    is joined; if it has state folders, one has to be named. The table may be a query:
    it runs once. Where it is too big to broadcast, a folder is spread over tasks by the
    share of the bytes it holds.
    """
    if not incremental:
        return df
    if isinstance(cursors, dict):
        known = {folder: last for folder, last in cursors.items() if last >= 0}
        if not known:
            return df
        keep = ~F.col("folder").isin(list(known))
        for folder, last in known.items():
            keep = keep | ((F.col("folder") == folder) & above(df, last))
        return df.filter(keep)
    cursors = cursors.filter(F.col("last_uid") >= 0)
    if state_folder is not None:
        last = cursors.filter(F.col("state_folder") == state_folder).select(
            "folder", F.col("last_uid").alias("_last_uid")
        )
    elif "state_folder" in cursors.columns:
        raise ValueError("name the state_folder whose cursors count")
    else:
        last = cursors.groupBy("folder").agg(F.max("last_uid").alias("_last_uid"))
    ident = [name for name in ("uid", "msg_num") if name in df.columns]
    joined = lookup_join(
        df, last, ["folder"], spread=ident, computed=True, weight=bytes_column(df)
    )
    return joined.filter(
        F.col("_last_uid").isNull() | above(df, F.col("_last_uid"))
    ).drop("_last_uid")


def highest_uid(success: DataFrame, *by: str) -> DataFrame:
    """Highest delivered UID per folder, real UIDs only."""
    return success.filter(F.col("uid") > 0).groupBy(*(by or ("folder",))).agg(
        F.max("uid").alias("last_uid")
    )


def advance_cursor(
    old: DataFrame, new: DataFrame, state_folder: str | None = None, incremental: bool = True
) -> DataFrame:
    """Old and new cursors merged: a cursor only ever goes up."""
    if not incremental:
        return old
    if state_folder is not None:
        new = new.withColumn("state_folder", F.lit(state_folder))
    columns = ["state_folder", "folder", "last_uid"]
    return (
        old.select(*columns).unionByName(new.select(*columns))
        .groupBy("state_folder", "folder")
        .agg(F.max("last_uid").alias("last_uid"))
    )


def with_state_key(cursors: DataFrame, target: str | None = None) -> DataFrame:
    """Cursors with the text key they are known by outside."""
    return cursors.withColumn(
        "state_key", state_key(F.col("state_folder"), F.lit(target), F.col("folder"))
    )
