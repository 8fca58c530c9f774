"""The cap and the batches against the row-by-row rule."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from mailloom.operators import limits
from mailloom.operators.limits import batch_number, cap_per_folder
from mailloom.plans.fetch import with_outcome


def walk(rows, batch_size, limit):
    """The rule, one message after the other."""
    kept = []
    for folder in sorted({row[0] for row in rows}):
        count = 0
        for _, ident, size in sorted((r for r in rows if r[0] == folder), key=lambda r: r[1]):
            kept.append((folder, ident))
            count += size <= limit
            if size <= limit and count >= batch_size * 10:
                break
    return sorted(kept)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    sizes = [(f"f{0 if n % 3 == 0 else n % 7}", n, rng.randrange(300)) for n in range(1, 2000)]
    return sizes + [("tiny", 5, 10), ("large", 6, 400), ("large", 7, 400)]


@pytest.mark.parametrize("batch_size", [1, 3, 10, 150])
def test_cap_equals_the_walk(spark, rows, batch_size):
    df = spark.createDataFrame(rows, "folder string, uid long, size long").repartition(9)
    routed = with_outcome(df, 200, "HEADERS_ONLY")
    kept = cap_per_folder(routed, batch_size, F.col("relationship") == "success")
    assert sorted((r.folder, r.uid) for r in kept.collect()) == walk(rows, batch_size, 200)


def test_cap_by_message_number(spark):
    rows = [("f", None, n, 1) for n in range(1, 31)]
    df = spark.createDataFrame(rows, "folder string, uid long, msg_num long, size long")
    kept = cap_per_folder(df, 1, F.col("size") > 0)
    assert sorted(r.msg_num for r in kept.collect()) == list(range(1, 11))


@pytest.mark.parametrize("width", [1, 7, 8192])
def test_cap_over_ranges_of_ids(spark, rows, monkeypatch, width):
    monkeypatch.setattr(limits, "RANGE", width)
    df = spark.createDataFrame(rows + [("f0", 30, 5), ("f0", 30, 5)], "folder string, uid long, size long")
    kept = cap_per_folder(df, 3, F.col("size") <= 200)
    want = sorted(rows + [("f0", 30, 5), ("f0", 30, 5)])
    # Rows that share an id with the last one come with it.
    ids = [u for f, u, size in want if f == "f0" and size <= 200]
    assert sorted(r.uid for r in kept.filter("folder = 'f0'").collect()) == [
        u for f, u, _ in want if f == "f0" and u <= ids[29]]
    numbered = batch_number(df, 3, F.col("size") <= 200).filter("folder = 'f1'")
    got = [r.batch_number for r in numbered.orderBy("uid").collect()]
    assert got == [n // 3 for n in range(len(got))] and len(got) == 30


def test_messages_without_ids_come_first(spark):
    rows = [("f", None, None, 1)] * 3 + [("f", None, n, 1) for n in range(1, 31)]
    df = spark.createDataFrame(rows, "folder string, uid long, msg_num long, size long")
    kept = cap_per_folder(df, 1, F.col("size") > 0)
    assert sorted(r.msg_num or 0 for r in kept.collect()) == [0, 0, 0, *range(1, 8)]


def test_no_window_over_a_folder(spark, rows):
    df = spark.createDataFrame(rows, "folder string, uid long, size long")
    ids = df.select("folder", F.col("uid").alias("_id"))
    ranges = limits.id_ranges(ids, ["folder"])
    # What a folder's window sees are counts of ranges, not messages.
    plan = ranges._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Aggregate")
    numbered = batch_number(df, 4, F.col("size") <= 200)
    windows = [line for line in numbered._jdf.queryExecution().optimizedPlan().toString().split("\n")
               if "row_number()" in line and "Window" in line]
    assert windows and all("_range" in line for line in windows)


def test_batches(spark, rows):
    df = spark.createDataFrame(rows, "folder string, uid long, size long")
    numbered = batch_number(df, 4, F.col("size") <= 200)
    for folder in ("f0", "f1", "tiny"):
        got = [(r.uid, r.batch_number)
               for r in numbered.filter(F.col("folder") == folder).orderBy("uid").collect()]
        good = [u for f, u in walk(rows, 4, 200) if f == folder
                and dict((x[1], x[2]) for x in rows if x[0] == f)[u] <= 200]
        assert got == [(uid, n // 4) for n, uid in enumerate(good)]
