"""Scalar functions over texts that are derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailloom.functions.dates import parse_day, utc_midnight
from mailloom.functions.text import (
    any_contains_ci,
    contains_ci,
    default_if_missing,
    epoch_millis_text,
    first_or,
    is_blank,
    mime_type,
    not_negative,
    power_of_two,
)
from mailloom.functions.units import data_size_bytes, time_period_ms
from suite import views


def date_layouts(spark, sf_dir):
    """Order dates written in every layout, some with an odd day or month name."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    layouts = ["dd-MMM-yyyy", "d-MMM-yyyy", "dd-MMM-yy", "yyyy-MM-dd", "dd/MM/yyyy",
               "MM/dd/yyyy", "dd MMM yyyy"]
    text = F.date_format(day, layouts[0])
    for number, layout in enumerate(layouts):
        text = F.when(key % 7 == number, F.date_format(day, layout)).otherwise(text)
    text = (
        F.when(key % 11 == 0, F.lower(F.date_format(day, layouts[0])))
        .when(key % 13 == 0, F.concat(F.lit("31-"), F.date_format(day, "MMM-yyyy")))
        .when(key % 17 == 0, F.concat(F.lit("32-"), F.date_format(day, "MMM-yyyy")))
        .otherwise(text)
    )
    written = views.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("written"))
    read = written.select("o_orderkey", parse_day(F.col("written")).alias("day"))
    return read.select(
        "o_orderkey",
        F.coalesce(F.col("day").cast("string"), F.lit("none")).alias("day"),
        F.coalesce(F.unix_millis(utc_midnight(F.col("day"))), F.lit(-1)).alias("midnight_ms"),
    )


_DATE_LAYOUTS = """WITH days AS (
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
read AS (
SELECT o_orderkey,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL
            WHEN o_orderkey % 13 = 0 THEN last_day(d)
            WHEN o_orderkey % 17 = 0 THEN NULL
            WHEN o_orderkey % 7 = 2 THEN make_date(2000 + year(d) % 100, month(d), day(d))
            WHEN o_orderkey % 7 = 5 AND day(d) <= 12 THEN make_date(year(d), day(d), month(d))
            ELSE d END AS day
FROM days)
SELECT o_orderkey, coalesce(CAST(day AS VARCHAR), 'none') AS day,
       coalesce(epoch_ms(CAST(day AS TIMESTAMP)), -1) AS midnight_ms FROM read"""


def data_sizes(spark, sf_dir):
    key = F.col("p_partkey") % 7
    number = F.col("p_size").cast("string")
    text = (
        F.when(key == 0, F.concat(number, F.lit(" KB")))
        .when(key == 1, F.concat(number, F.lit("B")))
        .when(key == 2, F.concat(F.lit(" "), number, F.lit("  mb")))
        .when(key == 3, F.concat(number, F.lit(".5 GB")))
        .when(key == 4, F.concat(number, F.lit(" Tb")))
        .when(key == 5, F.concat(number, F.lit(" XB")))
    )
    written = views.table(spark, sf_dir, "part").select("p_partkey", text.alias("written"))
    return written.select(
        "p_partkey", data_size_bytes(F.col("written"), 102400).alias("bytes"),
        data_size_bytes(F.col("written")).isNull().alias("unread"),
    )


_DATA_SIZES = """WITH sized AS (
SELECT p_partkey, CASE p_partkey % 7
  WHEN 0 THEN p_size * 1024 WHEN 1 THEN p_size WHEN 2 THEN p_size * 1048576
  WHEN 3 THEN CAST(p_size AS BIGINT) * 1073741824 + 536870912
  WHEN 4 THEN CAST(p_size AS BIGINT) * 1099511627776 END AS b
FROM part)
SELECT p_partkey, CAST(coalesce(b, 102400) AS BIGINT) AS bytes,
       b IS NULL AS unread FROM sized"""


def time_periods(spark, sf_dir):
    key = F.col("event_id") % 9
    number = F.col("user_id").cast("string")
    units = [" secs", "ms", " Min", " hours", " day", "wks", " nanos", " parsecs"]
    text = F.concat(number, F.lit(".5 sec"))
    for place, unit in enumerate(units):
        text = F.when(key == place, F.concat(number, F.lit(unit))).otherwise(text)
    written = views.table(spark, sf_dir, "events").select("event_id", text.alias("written"))
    return written.select("event_id", time_period_ms(F.col("written"), 10000).alias("ms"))


_TIME_PERIODS = """SELECT event_id, CAST(CASE event_id % 9
  WHEN 0 THEN user_id * 1000 WHEN 1 THEN user_id WHEN 2 THEN user_id * 60000
  WHEN 3 THEN user_id * 3600000 WHEN 4 THEN user_id * 86400000
  WHEN 5 THEN user_id * 604800000
  WHEN 6 THEN floor(user_id * 0.000001 + 0.5)
  WHEN 7 THEN 10000 ELSE user_id * 1000 + 500 END AS BIGINT) AS ms
FROM events"""


def text_functions(spark, sf_dir):
    ident = F.col("doc_id")
    kind = F.when(ident % 3 == 0, F.lit("text/plain ; charset=x")).otherwise(F.lit("image/png"))
    names = F.when(ident % 4 == 0, F.array().cast("array<string>")).otherwise(
        F.array("source", "lang")
    )
    return views.table(spark, sf_dir, "documents").select(
        "doc_id",
        is_blank(F.when(ident % 5 != 0, F.repeat(F.lit(" "), (ident % 5).cast("int"))))
        .alias("blank"),
        is_blank(F.col("text")).alias("blank_text"),
        contains_ci(F.col("text"), "QUE").alias("has_que"),
        any_contains_ci(names, "SRC1").alias("any_src1"),
        first_or(names, "none").alias("first_name"),
        mime_type(kind).alias("mime_type"),
        not_negative(F.col("n_chars") - 500).alias("above"),
        power_of_two(ident % 60 - 1).alias("power"),
        epoch_millis_text(
            F.when(ident % 2 == 0, F.timestamp_seconds(ident * 86400))
        ).alias("millis"),
        default_if_missing(F.when(ident % 6 == 0, F.col("n_chars")), -1).alias("defaulted"),
    )


_TEXT_FUNCTIONS = """SELECT doc_id, true AS blank,
  trim(text, ' ') = '' AS blank_text, contains(lower(text), 'que') AS has_que,
  doc_id % 4 <> 0 AND contains(source, 'src1') AS any_src1,
  CASE WHEN doc_id % 4 = 0 THEN 'none' ELSE source END AS first_name,
  CASE WHEN doc_id % 3 = 0 THEN 'text/plain' ELSE 'image/png' END AS mime_type,
  greatest(n_chars - 500, 0) AS above,
  CAST(floor(pow(2, doc_id % 60 - 1)) AS BIGINT) AS power,
  CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id * 86400000 AS VARCHAR) ELSE '' END AS millis,
  CASE WHEN doc_id % 6 = 0 THEN n_chars ELSE -1 END AS defaulted
FROM documents"""


QUERIES = {
    "date_layouts": (date_layouts, _DATE_LAYOUTS),
    "data_sizes": (data_sizes, _DATA_SIZES),
    "time_periods": (time_periods, _TIME_PERIODS),
    "text_functions": (text_functions, _TEXT_FUNCTIONS),
}
