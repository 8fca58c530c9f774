from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mailloom.operators import criteria as c

UTC = dt.timezone.utc
COLUMNS = (
    "uid long, flags array<string>, from_all array<string>, to_all array<string>, "
    "cc_all array<string>, bcc_all array<string>, subject string, "
    "headers array<struct<name string, value string>>, size long, "
    "received_ts timestamp, sent_ts timestamp"
)


@pytest.fixture(scope="module")
def mails(spark):
    return spark.createDataFrame(
        [
            (1, ["SEEN", "Work"], ["Ann <ann@x.org>"], ["bob@x.org"], [], ["eve@x.org"],
             "Weekly Report", [("X-Tag", "Blue sky")], 100,
             dt.datetime(2024, 1, 15, 0, 0, tzinfo=UTC),
             dt.datetime(2024, 1, 14, 23, 59, 59, tzinfo=UTC)),
            (2, ["RECENT", None], ["carl@x.org"], ["ann@x.org", "bob@y.org"], ["dan@x.org"], None,
             None, None, 200, dt.datetime(2024, 1, 15, 23, 59, 59, 999000, tzinfo=UTC), None),
            (3, None, None, None, None, None, "REPORT", [("x-tag", ""), ("Y", "blue")], None,
             None, dt.datetime(2024, 1, 15, 12, tzinfo=UTC)),
            (4, ["RECENT", "SEEN", "DELETED"], [], [], [], [], "", [], 0,
             dt.datetime(2024, 1, 16, tzinfo=UTC), dt.datetime(2024, 1, 16, tzinfo=UTC)),
        ],
        COLUMNS,
    )


def uids(df):
    return sorted(row.uid for row in df.select("uid").collect())


@pytest.mark.parametrize("make, expected", [
    (lambda: c.all_(), [1, 2, 3, 4]),
    (lambda: c.uid("5:*"), [1, 2, 3, 4]),
    (lambda: c.seen(), [1, 4]),
    (lambda: c.unseen(), [2, 3]),
    (lambda: c.deleted(), [4]),
    (lambda: c.undeleted(), [1, 2, 3]),
    (lambda: c.recent(), [2, 4]),
    (lambda: c.new(), [2]),
    (lambda: c.old(), [1, 3]),
    (lambda: c.answered(), []),
    (lambda: c.unflagged(), [1, 2, 3, 4]),
    (lambda: c.keyword("wORK"), [1]),
    (lambda: c.keyword("seen"), []),
    (lambda: c.unkeyword("work"), [2, 3, 4]),
    (lambda: c.from_("ANN"), [1]),
    (lambda: c.to("bob"), [1, 2]),
    (lambda: c.cc("dan@"), [2]),
    (lambda: c.bcc("EVE"), [1]),
    (lambda: c.subject("report"), [1, 3]),
    (lambda: c.subject(""), [1, 3, 4]),
    (lambda: c.header("X-TAG", "BLUE"), [1]),
    (lambda: c.header("x-tag", ""), [1, 3]),
    (lambda: c.since("15-Jan-2024"), [1, 2, 4]),
    (lambda: c.before("16-Jan-2024"), [1, 2]),
    (lambda: c.on(dt.date(2024, 1, 15)), [1, 2]),
    (lambda: c.sentsince("2024-01-15"), [3, 4]),
    (lambda: c.sentbefore("15-Jan-2024"), [1]),
    (lambda: c.senton("15/01/2024"), [3]),
    (lambda: c.larger(100), [2]),
    (lambda: c.smaller(100), [4]),
])
def test_criterion(mails, make, expected):
    condition = make()
    assert uids(mails.filter(condition)) == expected
    assert mails.filter(condition.isNull()).count() == 0


def test_terms_after_or_are_alternatives(mails):
    found = c.search(mails, all_of=[c.old()], any_of=[c.seen(), c.subject("report")])
    assert uids(found) == [1, 3]
    assert uids(c.search(mails, any_of=[c.deleted(), c.larger(150)])) == [2, 4]
    assert uids(c.search(mails)) == [1, 2, 3, 4]


def test_bad_criteria_raise(mails):
    with pytest.raises(PySparkException):
        mails.filter(c.since("yesterday")).count()
    with pytest.raises(ValueError):
        c.larger(2**31)
    with pytest.raises(ValueError):
        c.smaller("many")
    assert not hasattr(c, "body") and not hasattr(c, "text")


def test_days_are_utc_days_in_any_session_zone(spark, mails):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert uids(mails.filter(c.on("15-Jan-2024"))) == [1, 2]
        assert uids(mails.filter(c.since(dt.date(2024, 1, 16)))) == [4]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_comparisons_reach_the_scan(spark, mails, tmp_path):
    path = str(tmp_path / "mails")
    mails.write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    stored = spark.read.parquet(path)
    plan = stored.filter(c.since("15-Jan-2024") & c.larger(50)).select("uid")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(received_ts" in text
    assert "GreaterThan(size,50)" in text
    assert "headers" not in text and "subject" not in text


def test_empty_table(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert empty.filter(c.unseen() & c.subject("x")).count() == 0
    assert empty.agg(F.count("*")).first()[0] == 0
