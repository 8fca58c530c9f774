"""Choosing folders by path, depth and place in the tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.operators.joins import lookup_join


def folder_depth(path: Column, separator: str = "/") -> Column:
    """Number of path steps; the root, an empty path, has depth 0."""
    cut = F.length(path) - F.length(F.replace(path, F.lit(separator)))
    if len(separator) > 1:
        cut = F.floor(cut / len(separator))
    return F.when(path == "", 0).otherwise(cut + 1).cast("int")


def matches(path: Column, target: str) -> Column:
    """The target itself or, when it ends in ``*``, every path with that prefix."""
    if target.endswith("*"):
        return (path == target) | F.startswith(path, F.lit(target[:-1]))
    return path == target


def in_folder(
    df: DataFrame,
    target: str,
    recursive: bool = False,
    max_depth: int = -1,
    column: str = "folder",
) -> DataFrame:
    """Rows of one folder or, recursively, of all folders the target selects."""
    path = F.col(column)
    if not recursive:
        return df.filter(path == target)
    chosen = matches(path, target)
    if max_depth >= 0:
        chosen = chosen & (folder_depth(path) <= max_depth)
    return df.filter(chosen)


def ancestors(path: Column, separator: str = "/") -> Column:
    """Paths of all folders above, from the root down; none for the root."""
    steps = F.split(path, rf"\Q{separator}\E")
    above = F.transform(
        F.sequence(F.lit(0), F.size(steps) - 1),
        lambda n: F.array_join(F.slice(steps, F.lit(1), n), separator),
    )
    return F.when(path == "", F.array().cast("array<string>")).otherwise(above)


def folder_table(df: DataFrame, separator: str = "/") -> DataFrame:
    """The folder tree spanned by the folders that hold messages."""
    used = df.select(F.col("folder").alias("path")).distinct()
    lines = used.select(
        F.explode(
            F.concat(
                F.array(F.struct("path", F.lit(True).alias("m"), F.lit(False).alias("f"))),
                F.transform(
                    ancestors(F.col("path"), separator),
                    lambda p: F.struct(
                        p.alias("path"), F.lit(False).alias("m"), F.lit(True).alias("f")
                    ),
                ),
            )
        ).alias("line")
    ).select("line.*")
    tree = lines.groupBy("path").agg(
        F.bool_or("m").alias("holds_messages"), F.bool_or("f").alias("holds_folders")
    )
    return tree.select(
        "path", folder_depth(F.col("path"), separator).alias("depth"),
        "holds_messages", "holds_folders",
    )


def reachable_folders(folders: DataFrame, separator: str = "/") -> DataFrame:
    """Folders whose every ancestor holds only folders.

    A folder that holds messages, or that cannot hold folders, is itself
    reached but not entered.
    """
    closed = folders.filter(
        F.coalesce(F.col("holds_messages"), F.lit(False))
        | ~F.coalesce(F.col("holds_folders"), F.lit(False))
    ).select(F.col("path").alias("_above"))
    lines = folders.select("path", F.explode(ancestors(F.col("path"), separator)).alias("_above"))
    hidden = lookup_join(lines, closed, ["_above"], "left_semi", spread=["path"])
    return folders.join(hidden.select("path").distinct(), "path", "left_anti")
