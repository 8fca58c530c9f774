from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mailloom import FetchOptions
from mailloom.operators import criteria as c
from mailloom.operators.mailbox import expunge, flag_deleted, mark_read, resolve, with_marks
from mailloom.plans.poll import update_mailbox
from mailloom.sources.ingest import save_messages
from mailloom.sources.sinks import read_mark_steps
from mailloom.streaming.incremental import incremental_stream
from tests.test_streaming import SCHEMA, batch


@pytest.fixture(scope="module")
def box(spark):
    return spark.createDataFrame([
        ("a", 1, ["SEEN"]), ("a", 2, None), ("a", 3, ["DELETED"]), ("a", -1, []),
        ("b", 1, ["DELETED", "Work"]), ("b", 2, ["FLAGGED"]),
    ], "folder string, uid long, flags array<string>")


def flags(df):
    return {(r.folder, r.uid): r.flags for r in df.collect()}


def done(spark, *keys):
    return spark.createDataFrame(list(keys) or [], "folder string, uid long")


def test_mark_read(spark, box):
    after = flags(mark_read(box, done(spark, ("a", 1), ("a", 2), ("a", 2), ("a", -1), ("z", 9))))
    assert after == {("a", 1): ["SEEN"], ("a", 2): ["SEEN"], ("a", 3): ["DELETED"],
                     ("a", -1): [], ("b", 1): ["DELETED", "Work"], ("b", 2): ["FLAGGED"]}


def test_flag_deleted(spark, box):
    after = flags(flag_deleted(box, done(spark, ("b", 2), ("b", 1))))
    assert after[("b", 2)] == ["FLAGGED", "DELETED"]
    assert after[("b", 1)] == ["DELETED", "Work"]


def test_expunge_takes_every_deleted_message_of_a_touched_folder(spark, box):
    left = set(flags(expunge(box, done(spark, ("a", 1)))))
    assert left == {("a", 1), ("a", 2), ("a", -1), ("b", 1), ("b", 2)}
    assert len(flags(expunge(box, done(spark)))) == 6
    assert len(flags(expunge(box, done(spark, ("b", -1))))) == 6


def test_options_decide(spark, box):
    keys = done(spark, ("a", 1), ("b", 2))
    assert flags(update_mailbox(box, keys, FetchOptions())) == flags(box)
    after = flags(update_mailbox(box, keys, FetchOptions(mark_read=True)))
    assert after[("b", 2)] == ["FLAGGED", "SEEN"]
    after = flags(update_mailbox(box, keys, FetchOptions(delete_messages=True)))
    assert set(after) == {("a", 2), ("a", -1)}


def test_marks_of_a_log(spark, box):
    schema = "folder string, uid long, read boolean, deleted boolean"
    marks = spark.createDataFrame(
        [("a", 1, True, False), ("a", 2, True, False), ("a", 2, True, False), ("z", 1, True, True)], schema)
    after = flags(with_marks(box, marks))
    assert after == flags(box) | {("a", 2): ["SEEN"]}
    gone = spark.createDataFrame([("a", 1, False, True)], schema)
    # The message that was deleted, and the one of its folder that had the flag.
    assert set(flags(with_marks(box, gone))) == set(flags(box)) - {("a", 1), ("a", 3)}
    assert flags(with_marks(box, spark.createDataFrame([], schema))) == flags(box)


def test_a_stream_marks_what_it_delivers(spark, tmp_path):
    rows = batch(spark, ("a", 1, 1), ("a", 2, 1)).withColumn(
        "flags", F.when(F.col("uid") == 2, F.array(F.lit("SEEN"))).otherwise(F.array())
    )
    rows.write.parquet(str(tmp_path / "in"))
    incremental_stream(
        spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), str(tmp_path / "out"),
        str(tmp_path / "state"), str(tmp_path / "c"),
        FetchOptions(folder="a", mark_read=True, fetch_mode="HEADERS_ONLY"),
        all_of=[c.unseen()],
    ).awaitTermination()
    marks = read_mark_steps(spark, str(tmp_path / "state"), 1).collect()
    assert [(m.folder, m.uid, m.read, m.deleted) for m in marks] == [("a", 1, True, False)]


def test_resolve_drops_unknown_ids(spark, box):
    found = resolve(done(spark, ("a", 1), ("a", 1), ("b", 7)), box).collect()
    assert [(r.folder, r.uid) for r in found] == [("a", 1)]


def test_content_stays_where_it_lies(spark, tmp_path):
    rows = [(f, n, bytes(20) + str(n).encode()) for f in "ab" for n in range(1, 101)]
    mails = spark.createDataFrame(
        rows, "folder string, uid long, content binary"
    ).withColumn("message_id", F.concat("folder", F.col("uid").cast("string")))
    saved = save_messages(mails, "kept_mails", 8, str(tmp_path / "kept"))
    try:
        ids = done(spark, *[("a", n) for n in range(50, 151)], ("a", 60), ("c", 1), ("b", None))
        near, far = resolve(ids, saved), resolve(ids, saved, max_bytes=0)
        want = sorted(("a", n, bytes(20) + str(n).encode()) for n in range(50, 101))
        for found in (near, far):
            assert sorted((r.folder, r.uid, bytes(r.content)) for r in found.collect()) == want
        plan = resolve(ids, saved, max_bytes=0)._jdf.queryExecution().executedPlan().toString()
        # One exchange, that of the ids; the messages are neither moved nor sorted.
        assert "ShuffledHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1, plan
        assert "content" in plan[:plan.index("Exchange hashpartitioning")], plan
        assert "content" not in plan[plan.index("Exchange hashpartitioning"):], plan
        assert "Sort [" not in plan, plan
    finally:
        spark.sql("DROP TABLE kept_mails")


def test_ids_of_a_table_of_files(spark, box):
    found = resolve(done(spark, ("a", 1), ("a", 1), ("b", 7)), box, max_bytes=0).collect()
    assert [(r.folder, r.uid) for r in found] == [("a", 1)]
