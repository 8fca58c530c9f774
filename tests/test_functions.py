from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mailloom.functions.dates import parse_day
from mailloom.functions.text import flags_text, mime_type, power_of_two, state_key
from mailloom.functions.units import data_size_bytes, time_period_ms


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("text, day", [
    ("01-Jan-2024", dt.date(2024, 1, 1)),
    ("1-Jan-2024", dt.date(2024, 1, 1)),
    ("31-Dec-99", dt.date(2099, 12, 31)),
    ("2024-02-29", dt.date(2024, 2, 29)),
    ("03/04/2024", dt.date(2024, 4, 3)),
    ("03/25/2024", dt.date(2024, 3, 25)),
    ("25/03/2024", dt.date(2024, 3, 25)),
    ("05 Mar 2024", dt.date(2024, 3, 5)),
    ("30-Feb-2024", dt.date(2024, 2, 29)),
    ("31/04/2023", dt.date(2023, 4, 30)),
    ("01-JAN-2024", None),
    ("32-Jan-2024", None),
    ("00-Jan-2024", None),
    ("13/13/2024", None),
    ("2024-1-1", None),
    ("0000-01-01", None),
    ("soon", None),
    ("", None),
])
def test_date_layouts(spark, text, day):
    assert one(spark, parse_day(F.lit(text))) == day


@pytest.mark.parametrize("text, size", [
    ("100 KB", 102400), ("50MB", 50 * 1024**2), ("1.5 kb", 1536), ("7 B", 7),
    ("2 TB", 2 * 1024**4), (" 3 gb ", 3 * 1024**3), ("5", -1), ("five KB", -1), (None, -1),
    ("1.2345 KB", 1264),
])
def test_data_sizes(spark, text, size):
    assert one(spark, data_size_bytes(F.lit(text).cast("string"), -1)) == size


@pytest.mark.parametrize("text, ms", [
    ("10 secs", 10000), ("1 min", 60000), ("250ms", 250), ("1.5 hours", 5400000),
    ("2 DAYS", 172800000), ("1 wk", 604800000), ("900000 nanos", 1), ("-1 sec", -5),
    ("1.2.3 sec", -5), ("10", -5), (None, -5),
])
def test_time_periods(spark, text, ms):
    assert one(spark, time_period_ms(F.lit(text).cast("string"), -5)) == ms


def test_state_key(spark):
    key = state_key(F.lit("CUSTOMER_123"), F.lit("INBOX"), F.lit("INBOX/Subfolder"))
    assert one(spark, key) == "lastUID_CUSTOMER_123_INBOX_Subfolder"
    key = state_key(F.lit(None).cast("string"), F.lit("INBOX*"), F.lit("INBOX"))
    assert one(spark, key) == "lastUID_INBOX*_INBOX"


def test_small_functions(spark):
    flags = F.array(*[F.lit(x) for x in ("RECENT", "Work", "DELETED", "SEEN")])
    assert one(spark, flags_text(flags)) == "SEEN DELETED RECENT"
    assert one(spark, flags_text(F.lit(None).cast("array<string>"))) == ""
    assert one(spark, mime_type(F.lit("Text/Plain ; charset=x; y"))) == "Text/Plain"
    assert [one(spark, power_of_two(F.lit(n))) for n in (-1, 0, 1, 10)] == [0, 1, 2, 1024]
