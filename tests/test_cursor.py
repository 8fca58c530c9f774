from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mailloom import FetchOptions
from mailloom.operators.cursor import (
    advance_cursor,
    after_cursor,
    bytes_column,
    highest_uid,
    load_cursors,
    with_state_key,
)
from mailloom.plans.fetch import fetch

CURSORS = "state_folder string, folder string, last_uid long"


def mails(spark):
    rows = [("a", n, None) for n in range(1, 6)] + [("b", n, None) for n in range(1, 4)]
    rows += [("c", -1, n) for n in range(1, 4)] + [("c", None, 4)]
    return spark.createDataFrame(rows, "folder string, uid long, msg_num long")


def kept(df):
    return sorted((r.folder, r.uid if (r.uid or 0) > 0 else r.msg_num) for r in df.collect())


def test_only_newer_messages(spark):
    cursors = spark.createDataFrame([("s", "a", 3), ("s", "c", 2), ("t", "b", 2)], CURSORS)
    expected = [("a", 4), ("a", 5), ("b", 1), ("b", 2), ("b", 3), ("c", 3), ("c", 4)]
    assert kept(after_cursor(mails(spark), cursors, "s")) == expected
    assert kept(after_cursor(mails(spark), {"a": 3, "c": 2})) == expected
    assert len(kept(after_cursor(mails(spark), cursors, "s", incremental=False))) == 12
    # Cursors of several state folders are not mixed; those of none need no name.
    with pytest.raises(ValueError, match="state_folder"):
        after_cursor(mails(spark), cursors)
    assert kept(after_cursor(mails(spark), cursors.drop("state_folder"))) == [
        ("a", 4), ("a", 5), ("b", 3), ("c", 3), ("c", 4)]


def test_no_cursor_is_minus_one(spark):
    cursors = spark.createDataFrame([("s", "a", -1)], CURSORS)
    assert len(kept(after_cursor(mails(spark), cursors, "s"))) == 12
    assert len(kept(after_cursor(mails(spark), {"a": -1}))) == 12


def test_highest_uid_needs_real_uids(spark):
    assert sorted(map(tuple, highest_uid(mails(spark)).collect())) == [("a", 5), ("b", 3)]


def test_cursors_only_go_up(spark):
    old = spark.createDataFrame([("s", "a", 9), ("s", "b", 1), ("t", "a", 2)], CURSORS)
    new = spark.createDataFrame([("a", 5), ("b", 3), ("new", 1)], "folder string, last_uid long")
    merged = advance_cursor(old, new, "s")
    assert sorted(map(tuple, merged.collect())) == [
        ("s", "a", 9), ("s", "b", 3), ("s", "new", 1), ("t", "a", 2)]
    assert advance_cursor(old, new, "s", incremental=False) is old


def test_stored_text_values(spark):
    stored = spark.createDataFrame(
        [("s", "a", "12"), ("s", "b", "x"), ("s", "c", None), ("s", "d", "-1"), ("s", "e", "0")],
        "state_folder string, folder string, last_uid string")
    assert sorted(map(tuple, load_cursors(stored).collect())) == [("s", "a", 12), ("s", "e", 0)]


def test_state_keys(spark):
    cursors = spark.createDataFrame([("CUSTOMER_123", "INBOX/Subfolder", 1)], CURSORS)
    assert with_state_key(cursors).first().state_key == "lastUID_CUSTOMER_123_INBOX_Subfolder"


def test_failed_messages_do_not_raise_the_cursor(spark):
    df = spark.createDataFrame(
        [("INBOX", n, 500 if n in (3, 6) else 10) for n in range(1, 7)],
        "folder string, uid long, size long").selectExpr(
        "*", "cast(null as string) subject", "cast(null as array<string>) from_all",
        "cast(null as array<string>) to_all", "cast(null as array<string>) cc_all",
        "cast(null as timestamp) received_ts", "cast(null as timestamp) sent_ts",
        "cast(null as array<string>) flags", "cast(null as string) message_id")
    options = FetchOptions(max_message_size=100, fetch_mode="HEADERS_ONLY", incremental=True)
    cursors = spark.createDataFrame([("INBOX", "INBOX", 1)], CURSORS)
    run = fetch(df, options, cursors=cursors)
    assert run.cursors.first().last_uid == 5
    assert sorted(r.uid for r in run.success.collect()) == [2, 4, 5]
    assert [tuple(r) for r in run.parse_error.orderBy("uid").collect()] == [
        ("INBOX", 3, "MESSAGE_TOO_LARGE", "Message size 500 exceeds limit 100"),
        ("INBOX", 6, "MESSAGE_TOO_LARGE", "Message size 500 exceeds limit 100")]
    assert sorted(map(tuple, run.summary.collect()), key=str) == [
        ("INBOX", 5, True), (None, 5, True)]


def test_a_computed_cursor_table_runs_once(spark):
    mails = spark.range(1, 101).select(F.lit("a").alias("folder"), F.col("id").alias("uid"))
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    cursors = spark.createDataFrame([("a", 90)], "folder string, last_uid long").mapInPandas(
        counted, "folder string, last_uid long"
    )
    assert after_cursor(mails, cursors).count() == 10
    assert runs.value == 1


def test_a_folder_weighs_its_bytes(spark):
    mails = spark.createDataFrame(
        [("a", 1, 500, b""), ("a", 2, -1, b""), ("a", 3, None, b"")],
        "folder string, uid long, size long, content binary",
    )
    bare = mails.drop("content")
    assert [r[0] for r in mails.select(bytes_column(mails)).collect()] == [501, 1, 1]
    assert [r[0] for r in bare.select(bytes_column(bare)).collect()] == [1, 1, 1]
