"""Search criteria over the message view."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.operators import criteria as c
from suite import views
from suite.views import ARRIVALS, MESSAGES


def _tally(df: DataFrame, conditions: dict) -> DataFrame:
    """Matches and UID sum of each criterion, in one pass over the messages."""
    tallies = df.agg(*[
        F.struct(
            F.count_if(condition).alias("n"),
            F.coalesce(F.sum(F.when(condition, F.col("uid"))), F.lit(0)).alias("uid_sum"),
        ).alias(name)
        for name, condition in conditions.items()
    ])
    return tallies.unpivot([], list(conditions), "criterion", "tally").select(
        "criterion", "tally.n", "tally.uid_sum"
    )


def _tally_sql(view: str, conditions: dict[str, str], source: str = "messages") -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS criterion, count(*) FILTER (WHERE {condition}) AS n, "
        f"CAST(coalesce(sum(uid) FILTER (WHERE {condition}), 0) AS BIGINT) AS uid_sum "
        f"FROM {source}"
        for name, condition in conditions.items()
    )
    return f"WITH {view} {rows}"


_FLAG_SQL = {
    "all": "true", "seen": "seen", "unseen": "NOT seen", "answered": "answered",
    "unanswered": "NOT answered", "deleted": "deleted", "undeleted": "NOT deleted",
    "draft": "draft", "undraft": "NOT draft", "flagged": "flagged",
    "unflagged": "NOT flagged", "recent": "recent", "new": "recent AND NOT seen",
    "old": "NOT recent", "keyword": "kw_work", "unkeyword": "NOT kw_work",
    "keyword_none": "false", "uid": "true",
}


def search_flags(spark, sf_dir):
    plain = ["seen", "unseen", "answered", "unanswered", "deleted", "undeleted", "draft",
             "undraft", "flagged", "unflagged", "recent", "new", "old"]
    conditions = {"all": c.all_()}
    conditions |= {name: getattr(c, name)() for name in plain}
    conditions |= {"keyword": c.keyword("WORK"), "unkeyword": c.unkeyword("work"),
                   "keyword_none": c.keyword("seen"), "uid": c.uid("1:10")}
    return _tally(views.messages(spark, sf_dir), conditions)


_TEXT_SQL = {
    "from": "contains(sender, 'src1')",
    "from_case": "contains(sender, '@en.example')",
    "to": "contains(to_addr, 'reader1')",
    "cc": "contains(cc_addr, 'cc3@')",
    "cc_any": "cc_addr <> ''",
    "bcc": "contains(bcc_addr, 'bcc2')",
    "subject": "contains(lower(subject), 'th')",
    "subject_accent": "contains(lower(subject), 'é')",
    "header": "contains(x_lang, 'fr')",
    "header_any": "true",
    "header_other": "false",
}


def search_text(spark, sf_dir):
    return _tally(views.messages(spark, sf_dir), {
        "from": c.from_("src1"),
        "from_case": c.from_("@EN.Example"),
        "to": c.to("reader1"),
        "cc": c.cc("CC3@"),
        "cc_any": c.cc(""),
        "bcc": c.bcc("bcc2"),
        "subject": c.subject("TH"),
        "subject_accent": c.subject("É"),
        "header": c.header("x-LANG", "FR"),
        "header_any": c.header("X-Lang", ""),
        "header_other": c.header("X-Other", ""),
    })


_DATE_SQL = {
    "since": "received_ts >= TIMESTAMP '2024-01-15'",
    "before": "received_ts < TIMESTAMP '2024-01-20'",
    "on": "received_ts >= TIMESTAMP '2024-01-10' AND received_ts < TIMESTAMP '2024-01-11'",
    "sentsince": "coalesce(sent_ts >= TIMESTAMP '2024-01-15', false)",
    "sentbefore": "coalesce(sent_ts < TIMESTAMP '2024-01-15', false)",
    "senton": "coalesce(sent_ts >= TIMESTAMP '2024-01-12' AND sent_ts < TIMESTAMP '2024-01-13',"
              " false)",
    "clamped": "received_ts >= TIMESTAMP '2024-02-29'",
}


def search_dates(spark, sf_dir):
    return _tally(views.messages(spark, sf_dir), {
        "since": c.since("15-Jan-2024"),
        "before": c.before(dt.date(2024, 1, 20)),
        "on": c.on("10/01/2024"),
        "sentsince": c.sentsince("2024-01-15"),
        "sentbefore": c.sentbefore("15-Jan-24"),
        "senton": c.senton("12 Jan 2024"),
        "clamped": c.since("30-Feb-2024"),
    })


def search_arrival_dates(spark, sf_dir):
    found = c.search(
        views.arrivals(spark, sf_dir),
        all_of=[c.since("2-Jan-2024"), c.before("05-Jan-2024")],
        any_of=[c.larger(20000), c.on("03-Jan-2024")],
    )
    return found.select("folder", "uid", "size")


_SEARCH_ARRIVALS = f"""WITH {ARRIVALS}
SELECT folder, uid, size FROM arrivals
WHERE received_ts >= TIMESTAMP '2024-01-02' AND received_ts < TIMESTAMP '2024-01-05'
  AND (size > 20000 OR (received_ts >= TIMESTAMP '2024-01-03'
                        AND received_ts < TIMESTAMP '2024-01-04'))"""


def search_size(spark, sf_dir):
    return _tally(views.messages(spark, sf_dir), {
        "larger": c.larger(5000),
        "smaller": c.smaller(5000),
        "between": c.larger(1000) & c.smaller(2000),
        "none": c.larger(2**31 - 1),
    })


_SIZE_SQL = {
    "larger": "size > 5000",
    "smaller": "size < 5000",
    "between": "size > 1000 AND size < 2000",
    "none": "false",
}


def search_combined(spark, sf_dir):
    """``LARGER 200 OR FLAGGED SUBJECT an``: the words after OR are alternatives."""
    found = c.search(
        views.messages(spark, sf_dir),
        all_of=[c.larger(200), c.uid("1:*")],
        any_of=[c.flagged(), c.subject("an"), c.cc("cc1")],
    )
    return found.select("folder", "uid", "subject", "size")


_COMBINED = f"""WITH {MESSAGES}
SELECT folder, uid, subject, size FROM messages
WHERE size > 200 AND (flagged OR contains(lower(subject), 'an') OR contains(cc_addr, 'cc1'))"""


def search_any(spark, sf_dir):
    """``OR ANSWERED DRAFT``: only alternatives."""
    found = c.search(views.messages(spark, sf_dir), any_of=[c.answered(), c.draft()])
    return found.select("folder", "uid")


def search_empty(spark, sf_dir):
    return c.search(views.messages(spark, sf_dir)).groupBy("folder").agg(
        F.count(F.lit(1)).alias("n")
    )


QUERIES = {
    "search_flags": (search_flags, _tally_sql(MESSAGES, _FLAG_SQL)),
    "search_text": (search_text, _tally_sql(MESSAGES, _TEXT_SQL)),
    "search_dates": (search_dates, _tally_sql(MESSAGES, _DATE_SQL)),
    "search_arrival_dates": (search_arrival_dates, _SEARCH_ARRIVALS),
    "search_size": (search_size, _tally_sql(MESSAGES, _SIZE_SQL)),
    "search_combined": (search_combined, _COMBINED),
    "search_any": (
        search_any, f"WITH {MESSAGES} SELECT folder, uid FROM messages WHERE answered OR draft"
    ),
    "search_empty": (
        search_empty, f"WITH {MESSAGES} SELECT folder, count(*) AS n FROM messages GROUP BY folder"
    ),
}
