from __future__ import annotations

from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailloom.functions.attributes import request_attributes
from mailloom.operators import criteria as c
from mailloom.operators import joins
from mailloom.operators.requests import (
    classify,
    retry_ready,
    retry_route,
    route_requests,
    validate_requests,
    with_defaults,
)
from mailloom.plans import requests as plan
from mailloom.plans.requests import read_next_requests, run_request_step, run_requests
from mailloom.schema import FOLDER, MESSAGE, REQUEST

NOW = 1_000_000


def requests(spark, *rows):
    """Request rows from the options that are set."""
    names = REQUEST.fieldNames()
    return spark.createDataFrame(
        [tuple({"request_id": n, **row}.get(name) for name in names)
         for n, row in enumerate(rows, start=1)], REQUEST)


@pytest.mark.parametrize("options, error", [
    ({}, None),
    ({"folder": " "}, "INVALID_FOLDER"),
    ({"batch_size": 0}, "INVALID_BATCH_SIZE"),
    ({"batch_size": -5}, "INVALID_BATCH_SIZE"),
    ({"max_message_size": 0}, "INVALID_MAX_MESSAGE_SIZE"),
    ({"include_attachments": True, "max_attachment_size": 0}, "INVALID_MAX_ATTACHMENT_SIZE"),
    ({"include_attachments": True, "max_message_size": 1048576, "max_attachment_size": 5242880},
     "INVALID_SIZE_LIMITS"),
    ({"max_message_size": 1048576, "max_attachment_size": 5242880}, None),
    ({"include_attachments": True, "max_attachments": 0}, "INVALID_MAX_ATTACHMENTS"),
    ({"max_retries": -1}, "INVALID_MAX_RETRIES"),
    ({"max_retries": 0}, None),
    ({"retry_backoff_ms": 0}, "INVALID_RETRY_BACKOFF"),
    ({"retry_backoff_ms": -10000}, "INVALID_RETRY_BACKOFF"),
    ({"fetch_mode": "ATTACHMENTS_ONLY"}, "INVALID_FETCH_MODE"),
    ({"fetch_mode": "ATTACHMENTS_ONLY", "include_attachments": True}, None),
    ({"max_recursion_depth": 0}, "INVALID_MAX_RECURSION_DEPTH"),
    ({"max_recursion_depth": -2}, "INVALID_MAX_RECURSION_DEPTH"),
    ({"max_recursion_depth": -1}, None),
    ({"folder": "", "batch_size": 0}, "INVALID_FOLDER"),
])
def test_rules(spark, options, error):
    row = validate_requests(with_defaults(requests(spark, options))).first()
    assert row.error_type == error
    assert (row.error_message is None) == (error is None)


def test_defaults(spark):
    row = with_defaults(requests(spark, {}, {"include_attachments": True})).collect()
    first = row[0].asDict()
    assert first["folder"] == "INBOX" and first["batch_size"] == 10
    assert first["max_message_size"] == 100 * 1024 * 1024
    assert first["max_attachment_size"] == 2**63 - 1 and first["max_attachments"] == 2**31 - 1
    assert row[1].max_attachment_size == 50 * 1024 * 1024 and row[1].max_attachments == 100
    assert (first["max_retries"], first["retry_backoff_ms"]) == (3, 10000)


@pytest.mark.parametrize("count, waited, ready", [
    (None, 0, True), (0, 0, True), (1, 9999, False), (1, 10000, True),
    (2, 10000, False), (2, 20000, True), (4, 79999, False), (4, 80000, True), (3, None, True),
])
def test_retry_gate(spark, count, waited, ready):
    last = None if waited is None else NOW - waited
    row = with_defaults(requests(spark, {"retry_count": count, "retry_last_time_ms": last}))
    assert retry_ready(row, NOW).first().ready is ready


def test_waiting_request_goes_back_unchanged(spark):
    row = route_requests(with_defaults(requests(
        spark, {"batch_size": 0, "retry_count": 3, "retry_last_time_ms": NOW})), NOW).first()
    assert (row.relationship, row.retry_count, row.error_type) == ("retry", 3, None)


def test_retry_or_fail(spark):
    rows = with_defaults(requests(
        spark, {}, {"retry_count": 2}, {"retry_count": 3}, {"max_retries": 0}, {}))
    faults = spark.createDataFrame(
        [(n, "messaging", "down") for n in range(1, 5)] + [(5, "io", "odd")],
        "request_id long, kind string, message string")
    out = {r.request_id: r for r in retry_route(rows, classify(faults), NOW).collect()}
    assert [(out[n].relationship, out[n].retry_count, out[n].retry_last_time_ms,
             out[n].backoff_ms, out[n].error_type, out[n].error_message) for n in range(1, 6)] == [
        ("retry", 1, NOW, 10000, "CONNECTION_ERROR", "down"),
        ("retry", 3, NOW, 40000, "CONNECTION_ERROR", "down"),
        ("failure", 3, None, None, "CONNECTION_ERROR", "down - Max retries exceeded"),
        ("failure", None, None, None, "CONNECTION_ERROR", "down - Max retries exceeded"),
        ("failure", None, None, None, "UNEXPECTED_ERROR", "odd"),
    ]


@pytest.fixture(scope="module")
def mails(spark):
    rows = [(f, n, n * 10) for f in ("INBOX", "INBOX/a", "Lists/x") for n in range(1, 31)]
    return spark.createDataFrame(rows, "folder string, uid long, size long").selectExpr(
        "*", "concat(folder, '-', uid) AS subject", "array('me@x') AS from_all",
        "cast(null AS array<string>) AS to_all", "cast(null AS array<string>) AS cc_all",
        "cast(null AS array<string>) AS flags", "cast(null AS timestamp) AS received_ts",
        "cast(null AS timestamp) AS sent_ts", "concat('<', uid, '>') AS message_id",
        "cast('body' AS binary) AS content")


@pytest.fixture(scope="module")
def folders(spark):
    return spark.createDataFrame([
        ("", 0, False, True), ("INBOX", 1, True, True), ("INBOX/a", 2, True, False),
        ("Lists", 1, False, True), ("Lists/x", 2, True, False)], FOLDER)


def test_run(spark, mails, folders):
    asked = requests(
        spark,
        {"folder": "INBOX", "batch_size": 1, "fetch_mode": "HEADERS_ONLY"},
        {"folder": "Lists*", "recursive": True, "batch_size": 2, "include_headers": False},
        {"folder": "INBOX/a", "incremental": True, "state_folder": "s", "max_message_size": 200},
        {"folder": "INBOX/a", "incremental": False, "state_folder": "s", "batch_size": 1},
        {"folder": "gone"},
        {"folder": "gone", "max_retries": 0},
        {"folder": "none*", "recursive": True},
        {"folder": "INBOX", "batch_size": 0},
        {"folder": "INBOX", "retry_count": 1, "retry_last_time_ms": NOW - 1},
    ).withColumn("search", F.when(F.col("request_id") == 1, "big"))
    cursors = spark.createDataFrame([("s", "INBOX/a", 12), ("s", "INBOX", 5)],
                                    "state_folder string, folder string, last_uid long")
    run = run_requests(asked, folders, mails, NOW, cursors, searches={"big": c.larger(100)},
                       batch_id="b")
    got = {}
    for row in run.success.orderBy("uid").collect():
        got.setdefault((row.request_id, row.folder), []).append(row)
    assert {key: [r.uid for r in rows] for key, rows in got.items()} == {
        (1, "INBOX"): list(range(11, 21)),
        (2, "Lists/x"): list(range(1, 21)),
        (3, "INBOX/a"): list(range(13, 21)),
        (4, "INBOX/a"): list(range(1, 11)),
    }
    assert got[(1, "INBOX")][0].subject == "INBOX-11" and got[(1, "INBOX")][0].content is None
    second = got[(2, "Lists/x")][0]
    assert (second.subject, second.size, bytes(second.content)) == (None, None, b"body")
    assert second.batch_id == "b"
    assert sorted((r.request_id, r.uid) for r in run.parse_error.collect()) == [
        (3, n) for n in range(21, 31)]
    assert sorted(map(tuple, run.cursors.collect())) == [("s", "INBOX/a", 20)]
    assert sorted(map(tuple, run.processed.collect())) == [
        (1, "INBOX", 20), (2, "Lists/x", 30), (3, "INBOX/a", 18), (4, "INBOX/a", 30)]
    ends = {r.request_id: (r.relationship, r.error_type, r.error_message)
            for r in run.requests.collect()}
    assert ends == {
        1: ("original", None, None), 2: ("original", None, None), 3: ("original", None, None),
        4: ("original", None, None),
        5: ("retry", "CONNECTION_ERROR", "gone not found"),
        6: ("failure", "CONNECTION_ERROR", "gone not found - Max retries exceeded"),
        7: ("original", None, None),
        8: ("failure", "INVALID_BATCH_SIZE", "batch size must be positive"),
        9: ("retry", None, None),
    }


def _many(spark):
    """Ninety requests for one folder, with forty-five selections and two caps."""
    return with_defaults(requests(spark, *[
        {"folder": "INBOX", "batch_size": 1 + n % 2, "max_message_size": 50 + n // 2 * 5}
        for n in range(90)
    ]))


# In arrays of three, and with the selections dealt out rather than broadcast.
@pytest.mark.parametrize("per_row,most", [(64, 1 << 25), (3, 1 << 25), (3, 0)])
def test_many_selections_of_a_folder(spark, mails, folders, monkeypatch, per_row, most):
    monkeypatch.setattr(plan, "SELECTIONS_A_ROW", per_row)
    monkeypatch.setattr(plan, "lookup_join", partial(plan.lookup_join, max_bytes=most))
    run = plan.fetch_for_requests(_many(spark), folders, mails)
    good, bad = {}, {}
    for found, rows in ((good, run.success), (bad, run.parse_error)):
        for row in rows.collect():
            found.setdefault(row.request_id, []).append(row.uid)
    for n in range(90):
        limit, cap = 50 + n // 2 * 5, 10 + n % 2 * 10
        fits = [uid for uid in range(1, 31) if uid * 10 <= limit][:cap]
        over = [uid for uid in range(1, 31) if uid * 10 > limit] if len(fits) < cap else []
        assert sorted(good.get(n + 1, [])) == fits
        assert sorted(bad.get(n + 1, [])) == over
    assert {r.processed for r in run.processed.collect()} == {30}


def test_selections_meet_messages_without_a_shuffle(spark, mails):
    entries = spark.createDataFrame(
        [("INBOX", -1, True, 50 + n, "") for n in range(40)],
        "folder string, _last_uid long, _body boolean, max_message_size long, _search string")
    counted = plan._counted(plan._selected(mails, entries, None, ["uid"], 1, 4000))
    text = counted._jdf.queryExecution().executedPlan().toString()
    # From the top: sums, their exchange, sums per task, one row per message and selection.
    shuffled, summed, paired = (
        text.index("Exchange"), text.rindex("HashAggregate", 0, text.index("Generate")),
        text.index("Generate"))
    assert shuffled < summed < paired
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text[
        paired:text.index("BroadcastExchange", paired)]


def test_unknown_search_fails(spark, mails, folders):
    asked = requests(spark, {"folder": "INBOX"}).withColumn("search", F.lit("nope"))
    run = run_requests(asked, folders, mails, NOW, searches={})
    row = run.requests.first()
    assert (row.relationship, row.error_type) == ("failure", "FILTER_PARSE_ERROR")
    assert run.success.count() == 0


def test_request_attributes(spark):
    row = requests(spark, {"retry_count": 2}).selectExpr(
        "*", "'T' AS error_type", "cast(null AS string) AS error_message"
    ).select(request_attributes().alias("a")).first()
    assert row.a == {"retry.count": "2", "error.type": "T"}


def test_steps_on_disk(spark, tmp_path):
    """Two steps: marks and cursors of the first count in the second; the rest goes round."""
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    rows = [
        tuple({"folder": "a", "uid": k, "size": 10, "flags": []}.get(f.name) for f in MESSAGE.fields)
        for k in range(1, 26)
    ]
    mails = spark.createDataFrame(rows, MESSAGE)
    folders = spark.createDataFrame([tuple(
        {"path": "a"}.get(f.name, True if f.dataType.typeName() == "boolean" else None)
        for f in FOLDER.fields
    )], FOLDER)
    asked = spark.createDataFrame([
        (*[{"request_id": i, "folder": folder, "batch_size": 1, "incremental": i == 1,
            "state_folder": "s"}.get(f.name) for f in REQUEST.fields], i == 2, search)
        for i, folder, search in ((1, "a", None), (2, "a", "new"), (3, "gone", None))
    ], T.StructType([*REQUEST.fields, T.StructField("mark_read", T.BooleanType()),
                     T.StructField("search", T.StringType())]))
    for step in (0, 0, 1):
        run_request_step(
            asked, folders, mails, step, out, state, NOW, searches={"new": c.unseen()})
    have = {}
    for r in spark.read.parquet(out).collect():
        have.setdefault((r["step"], r["relationship"], r["request_id"]), []).append(r["uid"])
    first, second = list(range(1, 11)), list(range(11, 21))
    # The first request goes on above its cursor, the second takes what it has not marked.
    assert {k: sorted(v) for k, v in have.items() if k[1] == "success"} == {
        (0, "success", 1): first, (0, "success", 2): first,
        (1, "success", 1): second, (1, "success", 2): second}
    again = read_next_requests(spark, state, 1).collect()
    assert [(r["request_id"], r["retry_count"]) for r in again] == [(3, 1)]
    assert set(again[0].asDict()) == set(with_defaults(asked).columns)


def test_deliveries_are_dealt_out_however_few_files_the_mails_are_in(
    spark, mails, folders, monkeypatch
):
    monkeypatch.setattr(joins, "PAIR_BYTES", 100 * joins.PAIR_BASE)
    monkeypatch.setattr(joins, "CELL_RIGHT", 4)
    run = plan.fetch_for_requests(_many(spark), folders, mails.coalesce(1))
    per_task = run.success.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(per_task) == sum(
        min((50 + n // 2 * 5) // 10, 30, 10 + n % 2 * 10) for n in range(90))
    assert len(per_task) > 8 and max(per_task) < sum(per_task) / 4
