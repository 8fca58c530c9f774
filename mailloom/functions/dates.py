"""Calendar days in the layouts accepted by the date criteria."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted layouts in the order in which they are tried.
DATE_LAYOUTS = [
    "dd-MMM-yyyy",
    "d-MMM-yyyy",
    "dd-MMM-yy",
    "yyyy-MM-dd",
    "dd/MM/yyyy",
    "MM/dd/yyyy",
    "dd MMM yyyy",
]

_MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
_FIELDS = {
    "dd": "(0[1-9]|[12][0-9]|3[01])",
    "d": "(0{0,17}[1-9]|0{0,17}[12][0-9]|0{0,17}3[01])",
    "MMM": f"({'|'.join(_MONTHS)})",
    "MM": "(0[1-9]|1[0-2])",
    "yyyy": "(?!0000)([0-9]{4})",
    "yy": "([0-9]{2})",
}


def _as_iso(text: Column, layout: str) -> Column:
    """The text as ``yyyy-MM-dd`` if it has the layout; the day may not exist."""
    separator = next(ch for ch in layout if not ch.isalpha())
    fields = layout.split(separator)
    pattern = "^" + separator.join(_FIELDS[field] for field in fields) + "$"
    found = {
        field[0]: F.split_part(text, F.lit(separator), F.lit(number))
        for number, field in enumerate(fields, start=1)
    }
    year = F.concat(F.lit("20"), found["y"]) if "yy" in fields else found["y"]
    month = found["M"]
    if "MMM" in fields:
        names = F.array(*[F.lit(name) for name in _MONTHS])
        month = F.lpad(F.array_position(names, month).cast("string"), 2, "0")
    day = F.lpad(F.ltrim(found["d"], F.lit("0")), 2, "0")
    return F.when(F.regexp_like(text, F.lit(pattern)), F.concat_ws("-", year, month, day))


def parse_day(text: Column) -> Column:
    """Day of a date text in the first layout that fits, NULL when none does.

    A day past the end of its month (30-Feb) is taken as the month's last day;
    month names are matched in exact case.
    """
    iso = F.coalesce(*[_as_iso(text, layout) for layout in DATE_LAYOUTS])
    year, month, day = [F.substring(iso, at, n).cast("int") for at, n in ((1, 4), (6, 2), (9, 2))]
    first = F.make_date(year, month, F.lit(1))
    return F.date_add(first, F.least(day, F.dayofmonth(F.last_day(first))) - 1)


def utc_midnight(day) -> Column:
    """The instant at which a day begins in UTC, whatever the session time zone.

    ``day`` is a ``date``, a Column of dates, or a text in one of the layouts;
    a text that fits none raises when the plan runs.
    """
    if isinstance(day, str):
        day = F.coalesce(
            parse_day(F.lit(day)),
            F.raise_error(F.lit(f"not a date: {day}")).cast("date"),
        )
    elif isinstance(day, dt.date):
        day = F.lit(day)
    return F.timestamp_seconds(F.unix_date(day).cast("long") * 86_400)
