"""Search criteria: each one is a boolean Column that is never NULL.

Text matches are case-insensitive substrings, dates are whole UTC days, and a
missing value fails its criterion. There is no body search, by design.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.functions.dates import utc_midnight
from mailloom.functions.text import any_contains_ci, contains_ci, has_flag
from mailloom.schema import SYSTEM_FLAGS


def all_() -> Column:
    return F.lit(True)


def uid(uid_set: str) -> Column:
    """Accepted and without effect: only the cursor restricts UIDs."""
    return F.lit(True)


def seen() -> Column:
    return has_flag(F.col("flags"), "SEEN")


def unseen() -> Column:
    return ~seen()


def answered() -> Column:
    return has_flag(F.col("flags"), "ANSWERED")


def unanswered() -> Column:
    return ~answered()


def deleted() -> Column:
    return has_flag(F.col("flags"), "DELETED")


def undeleted() -> Column:
    return ~deleted()


def draft() -> Column:
    return has_flag(F.col("flags"), "DRAFT")


def undraft() -> Column:
    return ~draft()


def flagged() -> Column:
    return has_flag(F.col("flags"), "FLAGGED")


def unflagged() -> Column:
    return ~flagged()


def recent() -> Column:
    return has_flag(F.col("flags"), "RECENT")


def new() -> Column:
    return recent() & unseen()


def old() -> Column:
    return ~recent()


def keyword(name: str) -> Column:
    """A user flag, in any case; system flags do not count."""
    return F.coalesce(
        F.exists(
            F.col("flags"),
            lambda flag: (F.lower(flag) == name.lower()) & ~flag.isin(SYSTEM_FLAGS),
        ),
        F.lit(False),
    )


def unkeyword(name: str) -> Column:
    return ~keyword(name)


def from_(text: str) -> Column:
    return any_contains_ci(F.col("from_all"), text)


def to(text: str) -> Column:
    return any_contains_ci(F.col("to_all"), text)


def cc(text: str) -> Column:
    return any_contains_ci(F.col("cc_all"), text)


def bcc(text: str) -> Column:
    return any_contains_ci(F.col("bcc_all"), text)


def subject(text: str) -> Column:
    return contains_ci(F.col("subject"), text)


def header(name: str, text: str) -> Column:
    return F.coalesce(
        F.exists(
            F.col("headers"),
            lambda h: (F.lower(h["name"]) == name.lower()) & contains_ci(h["value"], text),
        ),
        F.lit(False),
    )


def _present(condition: Column, column: str) -> Column:
    return F.col(column).isNotNull() & condition


def since(day) -> Column:
    return _present(F.col("received_ts") >= utc_midnight(day), "received_ts")


def before(day) -> Column:
    return _present(F.col("received_ts") < utc_midnight(day), "received_ts")


def _within(column: str, day) -> Column:
    start = utc_midnight(day)
    return _present(
        (F.col(column) >= start) & (F.col(column) < start + F.expr("INTERVAL 24 HOURS")), column
    )


def on(day) -> Column:
    return _within("received_ts", day)


def sentsince(day) -> Column:
    return _present(F.col("sent_ts") >= utc_midnight(day), "sent_ts")


def sentbefore(day) -> Column:
    return _present(F.col("sent_ts") < utc_midnight(day), "sent_ts")


def senton(day) -> Column:
    return _within("sent_ts", day)


def _whole(number) -> int:
    number = int(number)
    if not -(2**31) <= number < 2**31:
        raise ValueError(f"not a 32-bit number: {number}")
    return number


def larger(size: int) -> Column:
    return _present(F.col("size") > _whole(size), "size")


def smaller(size: int) -> Column:
    return _present(F.col("size") < _whole(size), "size")


def combine(all_of=(), any_of=()) -> Column:
    """Every ``all_of`` criterion and, if there are any, at least one of ``any_of``."""
    terms = list(all_of)
    if any_of:
        terms.append(functools.reduce(operator.or_, any_of))
    return functools.reduce(operator.and_, terms, F.lit(True))


def search(df: DataFrame, all_of=(), any_of=()) -> DataFrame:
    """Messages that meet the criteria; all of them when there are none."""
    if not all_of and not any_of:
        return df
    return df.filter(combine(all_of, any_of))
