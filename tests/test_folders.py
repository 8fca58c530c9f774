from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mailloom.operators.folders import (
    ancestors,
    folder_depth,
    folder_table,
    in_folder,
    reachable_folders,
)
from mailloom.operators.requests import resolve_folders
from mailloom.schema import FOLDER

PATHS = ["", "INBOX", "INBOX/a", "INBOX/a/b", "INBOXES", "Lists", "Lists/x", "Lists/x/y"]


@pytest.fixture(scope="module")
def paths(spark):
    return spark.createDataFrame([(p,) for p in PATHS], "folder string")


def chosen(df):
    return sorted(r.folder for r in df.collect())


def test_selection(paths):
    assert chosen(in_folder(paths, "INBOX")) == ["INBOX"]
    assert chosen(in_folder(paths, "INBOX*")) == []
    assert chosen(in_folder(paths, "INBOX", recursive=True)) == ["INBOX"]
    assert chosen(in_folder(paths, "INBOX*", recursive=True)) == [
        "INBOX", "INBOX/a", "INBOX/a/b", "INBOXES"]
    assert chosen(in_folder(paths, "INBOX/*", recursive=True)) == ["INBOX/a", "INBOX/a/b"]
    assert chosen(in_folder(paths, "*", recursive=True)) == sorted(PATHS)
    assert chosen(in_folder(paths, "*", recursive=True, max_depth=0)) == [""]
    assert chosen(in_folder(paths, "INBOX*", True, max_depth=2)) == ["INBOX", "INBOX/a", "INBOXES"]
    assert chosen(in_folder(paths, "Lists/x/y", True, max_depth=2)) == []


def test_depth_and_ancestors(spark, paths):
    rows = paths.select("folder", folder_depth(F.col("folder")), ancestors(F.col("folder")))
    found = {r[0]: (r[1], r[2]) for r in rows.collect()}
    assert found[""] == (0, [])
    assert found["INBOX"] == (1, [""])
    assert found["Lists/x/y"] == (3, ["", "Lists", "Lists/x"])
    dots = spark.createDataFrame([("a.b.c",), ("a::b",)], "p string")
    assert [r[0] for r in dots.select(folder_depth(F.col("p"), ".")).collect()] == [3, 1]
    assert [r[0] for r in dots.select(folder_depth(F.col("p"), "::")).collect()] == [1, 2]
    assert dots.select(ancestors(F.col("p"), ".")).first()[0] == ["", "a", "a.b"]


def test_tree_of_used_folders(spark):
    used = spark.createDataFrame([("a/b",), ("a/b",), ("a/c/d",), ("a/c",)], "folder string")
    rows = sorted(map(tuple, folder_table(used).collect()))
    assert rows == [("", 0, False, True), ("a", 1, False, True), ("a/b", 2, True, False),
                    ("a/c", 2, True, True), ("a/c/d", 3, True, False)]


def tree(spark):
    return spark.createDataFrame([
        ("", 0, False, True), ("INBOX", 1, True, True), ("INBOX/a", 2, True, False),
        ("Lists", 1, False, True), ("Lists/x", 2, True, False), ("Lists/z", 2, False, True),
        ("Lists/z/1", 3, True, False), ("Odd", 1, False, False), ("Odd/in", 2, True, False),
    ], FOLDER)


def test_only_pure_folders_are_entered(spark):
    reached = sorted(r.path for r in reachable_folders(tree(spark)).collect())
    assert reached == ["", "INBOX", "Lists", "Lists/x", "Lists/z", "Lists/z/1", "Odd"]


def test_requests_to_folders(spark):
    requests = spark.createDataFrame([
        (1, "INBOX", False, 5), (2, "gone", False, 5), (3, "Lists*", True, -1),
        (4, "Lists*", True, 2), (5, "Lists/z", True, 5), (6, "INBOX/a", True, 5),
        (7, "*", True, 1), (8, "Li", True, 5), (9, "INBOX/a", False, 1),
    ], "request_id long, folder string, recursive boolean, max_recursion_depth int")
    pairs = sorted(map(tuple, resolve_folders(requests, tree(spark)).collect()))
    assert pairs == [
        (1, "INBOX"), (2, "gone"), (3, "Lists"), (3, "Lists/x"), (3, "Lists/z"), (3, "Lists/z/1"),
        (4, "Lists"), (4, "Lists/x"), (4, "Lists/z"), (5, "Lists/z"),
        (7, ""), (7, "INBOX"), (7, "Lists"), (7, "Odd"), (9, "INBOX/a"),
    ]


def test_requests_look_up_folders_where_they_are_read(spark):
    # More requests than are broadcast, for the same few folders: none is copied to salts.
    asked = spark.range(0, 120_000, 1, 4).select(
        F.col("id").alias("request_id"), F.lit("Lists*").alias("folder"), F.lit(True).alias("recursive"),
        F.lit(-1).alias("max_recursion_depth"), F.lit("s" * 300).alias("state_folder"),
    )
    found = resolve_folders(asked, tree(spark), keep=["state_folder"])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "_salt" not in text
    assert found.count() == 4 * 120_000
