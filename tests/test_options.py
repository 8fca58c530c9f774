"""Options that break a rule, by every way in; and numbers that do not fit."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailloom import FetchOptions
from mailloom.functions.text import power_of_two
from mailloom.functions.units import data_size_bytes, time_period_ms
from mailloom.operators.limits import cap_per_folder
from mailloom.operators.requests import next_backoff, retry_ready, retry_route
from mailloom.plans.fetch import fetch
from mailloom.plans.poll import poll, run_step
from mailloom.plans.requests import run_requests
from mailloom.sources.landing import read_raw
from mailloom.sources.mime import decode_words, parse_mail

LONG_MAX = 2**63 - 1

BROKEN = [
    {"folder": " "}, {"batch_size": 0}, {"batch_size": -5}, {"max_message_size": 0},
    {"include_attachments": True, "max_attachment_size": 0},
    {"include_attachments": True, "max_attachment_size": 2**40},
    {"include_attachments": True, "max_attachments": 0}, {"max_retries": -1},
    {"retry_backoff_ms": 0}, {"fetch_mode": "ATTACHMENTS_ONLY"}, {"fetch_mode": "all"},
    {"max_recursion_depth": 0}, {"max_recursion_depth": -2},
]


def mails(spark, n=3):
    return spark.createDataFrame(
        [("a", k, 1, f"s{k}", None, None, None) for k in range(1, n + 1)],
        "folder string, uid long, size long, subject string, error_message string, "
        "content binary, received_ts timestamp",
    )


@pytest.mark.parametrize("broken", BROKEN, ids=str)
def test_broken_options(spark, broken, tmp_path):
    options = replace(FetchOptions(folder="a"), **broken)
    cursors = spark.createDataFrame([], "state_folder string, folder string, last_uid long")
    for way in (
        lambda: fetch(mails(spark), options),
        lambda: poll(mails(spark), cursors, options),
        lambda: run_step(mails(spark), 0, str(tmp_path / "o"), str(tmp_path / "s"), options),
    ):
        with pytest.raises(ValueError):
            way()


def test_an_empty_batch_caps_nothing_away(spark):
    with pytest.raises(ValueError):
        cap_per_folder(mails(spark), 0, F.lit(True))


def test_numbers_that_do_not_fit(spark):
    row = spark.range(1).select(
        power_of_two(F.lit(62)), power_of_two(F.lit(63)), power_of_two(F.lit(2000)),
        power_of_two(F.lit(None).cast("int")), data_size_bytes(F.lit("99999999999 TB"), 7),
        data_size_bytes(F.lit("2 KB"), 7), time_period_ms(F.lit("9" * 30 + " days"), 8),
    ).first()
    assert tuple(row) == (2**62, LONG_MAX, LONG_MAX, None, 7, 2048, 8)


def test_many_retries_do_not_end_the_run(spark):
    asked = spark.createDataFrame(
        [(n, 10_000, n, 1_000) for n in range(0, 201)],
        "request_id long, retry_backoff_ms long, retry_count int, retry_last_time_ms long",
    )
    waits = {r["retry_count"]: r["w"] for r in asked.select("retry_count", next_backoff().alias("w")).collect()}
    assert waits == {n: min(10_000 * 2**n, LONG_MAX) for n in waits}
    ready = {r["request_id"] for r in retry_ready(asked, 2**40).collect() if r["ready"]}
    assert ready == {n for n in waits if n == 0 or 2**40 - 1_000 >= 10_000 * 2 ** (n - 1)}


def test_one_fault_of_a_request_counts(spark):
    asked = spark.createDataFrame(
        [(1, 3, 10, 0, None), (2, 3, 10, 0, None)],
        "request_id long, max_retries int, retry_backoff_ms long, retry_count int, "
        "retry_last_time_ms long",
    )
    faults = spark.createDataFrame(
        [(1, "CONNECTION_ERROR", "b", "retry"), (1, "UNEXPECTED_ERROR", "c", "failure"),
         (2, "CONNECTION_ERROR", "b", "retry"), (2, "CONNECTION_ERROR", "a", "retry")],
        "request_id long, error_type string, error_message string, relationship string",
    )
    have = sorted((r["request_id"], r["error_message"], r["relationship"])
                  for r in retry_route(asked, faults, 5).collect())
    assert have == [(1, "c", "failure"), (2, "a", "retry")]


def test_named_searches_without_criteria(spark):
    from mailloom.schema import REQUEST

    rows = [
        (*[{"request_id": k, "folder": "a"}.get(f.name) for f in REQUEST.fields], search)
        for k, search in ((1, "flagged"), (2, None))
    ]
    asked = spark.createDataFrame(rows, T.StructType([*REQUEST.fields, T.StructField("search", T.StringType())]))
    for searches in (None, {}, {"other": F.lit(True)}):
        run = run_requests(asked, _tree(spark), _whole(spark), 0, searches=searches)
        out = {r["request_id"]: (r["relationship"], r["error_message"]) for r in run.requests.collect()}
        assert out == {1: ("failure", "unknown search: flagged"), 2: ("original", None)}
        assert {r["request_id"] for r in run.success.collect()} == {2}


def _tree(spark):
    from mailloom.schema import FOLDER

    names = FOLDER.fieldNames()
    values = {"path": "a"}
    row = tuple(
        values.get(f.name, True if f.dataType.typeName() == "boolean" else None) for f in FOLDER.fields
    )
    assert "path" in names
    return spark.createDataFrame([row], FOLDER)


def _whole(spark):
    from mailloom.schema import MESSAGE

    rows = [
        tuple({"folder": "a", "uid": k, "size": 1}.get(f.name) for f in MESSAGE.fields)
        for k in (1, 2)
    ]
    return spark.createDataFrame(rows, MESSAGE)


def test_folder_names_are_taken_as_they_are(spark, tmp_path):
    for folder in ("[Gmail]/Sent", "a*b", "{x,y}"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "7.eml").write_bytes(b"Subject: x\r\n\r\nhello")
        row = read_raw(spark, f"file://{tmp_path}", folder).collect()
        assert [(r["folder"], r["uid"]) for r in row] == [(folder, 7)]


def test_deep_nests_and_odd_charsets():
    depth = 1200
    mail = b"".join(
        b"Content-Type: multipart/mixed; boundary=b%d\r\n\r\n--b%d\r\n" % (k, k) for k in range(depth)
    ) + b"Content-Type: text/plain\r\nContent-Disposition: attachment; filename=x.txt\r\n\r\nhi\r\n"
    row = parse_mail(b"Subject: deep\r\n" + mail)
    assert row["subject"] == "deep" and [p["filename"] for p in row["parts"]] == ["x.txt"]
    assert row["parts"][0]["part_path"] == [0] * depth
    assert decode_words("=?a\0b?q?x?=") == "=?a\0b?q?x?=".replace("\0", "\0")
