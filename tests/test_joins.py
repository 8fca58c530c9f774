from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mailloom.operators import joins
from mailloom.operators.joins import SALTS, hot_keys, lookup_join, measured_bytes


@pytest.fixture(scope="module")
def big(spark):
    """A third of the rows has the same key."""
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("key"),
    )


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([("hot", 1)] + [(f"k{n}", n) for n in range(0, 50, 2)],
                                 "key string, value int")


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("computed", [False, True])
def test_both_ways_agree(big, small, how, computed):
    condition = F.col("id") % 2 == 0 if how == "left_anti" else None
    near = lookup_join(big, small, ["key"], how, condition=condition, computed=computed)
    far = lookup_join(big, small, ["key"], how, spread=["id"], condition=condition, max_bytes=0)
    plain = big.join(small, "key", how) if condition is None else big.join(
        small.withColumnRenamed("key", "k2"), (F.col("key") == F.col("k2")) & condition, how)
    unsalted = lookup_join(big, small, ["key"], how, condition=condition, max_bytes=0)
    assert rows(near) == rows(far) == rows(unsalted) == rows(plain)


def test_salting_spreads_the_hot_key(big, small):
    far = lookup_join(big, small, ["key"], "left", spread=["id"], max_bytes=0)
    assert far.columns == ["id", "key", "value"]
    salted = big.filter("key = 'hot'").groupBy(
        F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt")
    ).count()
    assert salted.count() == SALTS
    assert salted.agg(F.max("count")).first()[0] < 1000 / SALTS * 2


def test_measured_bytes(spark, small):
    assert measured_bytes(small) == 26 * 32 + 3 + 5 * 2 + 20 * 3
    assert measured_bytes(small.filter("value < 0")) == 0
    with pytest.raises(TypeError):
        measured_bytes(spark.sql("SELECT array(1) AS a"))


def test_hot_keys_hold_more_than_a_share(spark, big):
    hot = hot_keys(big, ["key"], F.lit(1))
    # A third of 3,000 rows is 6 of 16 shares; the 50 others hold 40 rows each, under one.
    assert [(r.key, r._cuts) for r in hot.collect()] == [("hot", 6)]
    assert hot_keys(big.limit(0), ["key"], F.lit(1)).count() == 0
    # By weight another key is the large one.
    heavy = F.when(F.col("key") == "k7", 1000).otherwise(1)
    assert {r.key for r in hot_keys(big, ["key"], heavy).collect()} == {"k7"}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_measured_salts_agree(spark, big, small, how):
    odd = big.withColumn("key", F.when(F.col("id") % 5 > 0, F.col("key")))  # null keys, many
    far = lookup_join(odd, small, ["key"], how, spread=["id"], max_bytes=0, weight=F.lit(1))
    assert rows(far) == rows(odd.join(small, "key", how))
    assert sorted(far.columns) == sorted(odd.join(small, "key", how).columns)


def test_measured_salts_copy_hot_keys_only(spark, big, small):
    far = lookup_join(big, small, ["key"], "left", spread=["id"], max_bytes=0, weight=F.lit(1))
    sizes = spark.createDataFrame([(None, 3)], "key string, value int")
    assert far.filter("key = 'hot'").agg(F.count("value")).first()[0] == 1000
    assert lookup_join(big, sizes, ["key"], "inner", spread=["id"], max_bytes=0,
                       weight=F.lit(1)).count() == 0


def test_pairs_come_from_as_many_tasks_as_they_have_bytes(spark, monkeypatch):
    monkeypatch.setattr(joins, "CELL_LEFT", 10)
    monkeypatch.setattr(joins, "CELL_RIGHT", 7)
    monkeypatch.setattr(joins, "PAIR_BYTES", 4 * joins.PAIR_BASE * 100)
    # One hot key, one small one, and one on either side only; rows may come twice.
    left = spark.range(50).selectExpr("if(id < 45, 1, if(id < 48, 2, 3)) AS k", "id % 40 AS a")
    right = spark.range(60).selectExpr("if(id < 50, 1, if(id < 55, 2, 4)) AS k", "id % 30 AS b")
    met = joins.pairs_join(left, right, ["k"], ["a"], ["b"])
    assert sorted(map(tuple, met.select("k", "a", "b").collect())) == sorted(
        map(tuple, left.join(right, "k").select("k", "a", "b").collect()))
    filled = [n for n in met.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert met.rdd.getNumPartitions() == 6 and len(filled) > 3 and max(filled) < 1500
    none = joins.pairs_join(left.limit(0), right, ["k"], ["a"], ["b"], F.lit(3))
    assert none.count() == 0 and none.columns == ["k", "a", "b"]
