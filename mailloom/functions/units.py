"""Data sizes and time periods written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bytes per data unit.
DATA_UNITS = {"B": 1, "KB": 1024, "MB": 1024**2, "GB": 1024**3, "TB": 1024**4}

# Spellings of the time units and their length in milliseconds.
TIME_UNITS = [
    (["ns", "nano", "nanos", "nanosecond", "nanoseconds"], 0.000001),
    (["ms", "milli", "millis", "millisecond", "milliseconds"], 1),
    (["s", "sec", "secs", "second", "seconds"], 1_000),
    (["m", "min", "mins", "minute", "minutes"], 60_000),
    (["h", "hr", "hrs", "hour", "hours"], 3_600_000),
    (["d", "day", "days"], 86_400_000),
    (["w", "wk", "wks", "week", "weeks"], 604_800_000),
]


def data_size_bytes(text: Column, default=None) -> Column:
    """Whole bytes of a text such as ``100 KB`` (1 KB = 1024 B), else the default."""
    text = F.upper(F.trim(text))
    pattern = rf"^([0-9]+(?:\.[0-9]+)?)\s*({'|'.join(DATA_UNITS)})$"
    number = F.regexp_extract(text, pattern, 1).try_cast("double")
    unit = F.regexp_extract(text, pattern, 2)
    factor = F.lit(None).cast("long")
    for name, size in DATA_UNITS.items():
        factor = F.when(unit == name, F.lit(size)).otherwise(factor)
    return F.coalesce((number * factor).try_cast("long"), F.lit(default).cast("long"))


def time_period_ms(text: Column, default=None) -> Column:
    """Whole milliseconds of a text such as ``10 secs``, else the default."""
    text = F.lower(F.trim(text))
    spellings = [name for names, _ in TIME_UNITS for name in names]
    pattern = rf"^([0-9.]+)\s*({'|'.join(spellings)})$"
    number = F.regexp_extract(text, pattern, 1).try_cast("double")
    unit = F.regexp_extract(text, pattern, 2)
    factor = F.lit(None).cast("double")
    for names, length in TIME_UNITS:
        factor = F.when(unit.isin(names), F.lit(float(length))).otherwise(factor)
    whole = number * factor + 0.5
    fits = F.when(whole < float(2**63), F.floor(whole))
    return F.coalesce(fits, F.lit(default).cast("long"))
