"""Small string and array functions (Column in, Column out)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailloom.schema import SYSTEM_FLAGS


def is_blank(text: Column) -> Column:
    """True for NULL, empty and all-space text."""
    return F.coalesce(F.trim(text) == "", F.lit(True))


def contains_ci(text: Column, part) -> Column:
    """Case-insensitive substring test; a missing text contains nothing."""
    part = part if isinstance(part, Column) else F.lit(part)
    return F.coalesce(F.contains(F.lower(text), F.lower(part)), F.lit(False))


def any_contains_ci(texts: Column, part) -> Column:
    """True if some element of the array contains ``part`` in any case."""
    return F.coalesce(F.exists(texts, lambda text: contains_ci(text, part)), F.lit(False))


def first_or(values: Column, default) -> Column:
    """First element of an array, or the default when there is none."""
    return F.coalesce(F.try_element_at(values, F.lit(1)), F.lit(default))


def flags_or_empty(flags: Column) -> Column:
    return F.coalesce(flags, F.array().cast("array<string>"))


def has_flag(flags: Column, flag: str) -> Column:
    return F.coalesce(F.array_contains(flags, flag), F.lit(False))


def flags_text(flags: Column) -> Column:
    """System flags in their fixed order, space-separated; keywords are left out."""
    order = F.array(*[F.lit(flag) for flag in SYSTEM_FLAGS])
    return F.array_join(F.array_intersect(order, flags_or_empty(flags)), " ")


def mime_type(content_type: Column) -> Column:
    """Text before the first ``;`` of a Content-Type, trimmed."""
    return F.trim(F.substring_index(content_type, ";", 1))


def state_key(state_folder: Column, target: Column, folder: Column) -> Column:
    """Text key of a cursor: ``lastUID_<state folder or target>_<folder with _ for />``."""
    return F.concat(
        F.lit("lastUID_"), F.coalesce(state_folder, target),
        F.lit("_"), F.translate(folder, "/", "_"),
    )


def epoch_millis_text(ts: Column) -> Column:
    """Epoch milliseconds as text, empty when the time is missing."""
    return F.coalesce(F.unix_millis(ts).cast("string"), F.lit(""))


def not_negative(number: Column) -> Column:
    """The number, or 0 when it is negative or missing."""
    return F.greatest(F.coalesce(number, F.lit(0)), F.lit(0)).cast("long")


def power_of_two(exponent: Column) -> Column:
    """2 to the exponent as a whole number; 0 below exponent 0, the largest one from 63 on."""
    return F.when(exponent >= 63, F.lit(2**63 - 1)).when(
        exponent.isNotNull(), F.pow(F.lit(2.0), exponent).cast("long")
    )


def capped_product(a: Column, b: Column) -> Column:
    """The product, or the largest number where it does not fit; NULL if a factor is."""
    product = F.coalesce(F.try_multiply(a, b), F.lit(2**63 - 1))
    return F.when(a.isNotNull() & b.isNotNull(), product)


def default_if_missing(value: Column, default) -> Column:
    return F.coalesce(value, default if isinstance(default, Column) else F.lit(default))
