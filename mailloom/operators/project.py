"""What a fetch shows of each message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.functions.attributes import message_attributes
from mailloom.functions.text import first_or, flags_text, not_negative
from mailloom.schema import (
    ATTACHMENTS_ONLY,
    FULL_MESSAGE,
    HEADER_ORDER,
    HEADERS_ONLY,
)

FETCH_MODES = (HEADERS_ONLY, FULL_MESSAGE, ATTACHMENTS_ONLY)


def wants_body(mode: Column) -> Column:
    """True for a mode that shows the content: any but the two that leave it out."""
    return ~mode.isin(HEADERS_ONLY, ATTACHMENTS_ONLY)


def header_fault_at(df: DataFrame) -> Column:
    """1-based place of the header at which reading stopped, 0 when it did not."""
    return F.expr(_fault_at(df))


def _fault_at(df: DataFrame) -> str:
    if "header_fault" not in df.columns:
        return "0L"
    order = ", ".join(f"'{name}'" for name in HEADER_ORDER)
    return f"coalesce(array_position(array({order}), header_fault), 0L)"


def first_sender(df: DataFrame) -> Column:
    """First From address, else the Sender address, else ``unknown``."""
    return F.expr(_first_sender(df))


def _first_sender(df: DataFrame) -> str:
    sender = "try_element_at(sender_all, 1), " if "sender_all" in df.columns else ""
    return f"coalesce(try_element_at(from_all, 1), {sender}'unknown')"


def optional(df: DataFrame, column: str, kind: str) -> Column:
    """The column, or NULL in a table that does not have it."""
    return F.col(column) if column in df.columns else F.lit(None).cast(kind)


def _base_columns(df: DataFrame) -> list[Column]:
    return [
        optional(df, "batch_id", "string").alias("batch_id"),
        F.col("folder"),
        F.when(F.col("uid") > 0, F.col("uid")).alias("uid"),
    ]


def project_base(df: DataFrame, *extra: Column) -> DataFrame:
    """Batch, folder and UID; the UID only where there is one."""
    return df.select(*_base_columns(df), *extra)


def header_columns(df: DataFrame) -> list[Column]:
    """The ten header columns, with defaults for what a mail does not have.

    A header that could not be read, and every header after it, is NULL.
    """
    in_reply_to = "in_reply_to" if "in_reply_to" in df.columns else "NULL"
    shown = {
        "subject": ("subject", F.expr("coalesce(subject, '')")),
        "from": ("sender", first_sender(df)),
        "to": ("to_addr", first_or(F.col("to_all"), "")),
        "cc": ("cc_addr", first_or(F.col("cc_all"), "")),
        "received": ("received_ts", F.col("received_ts")),
        "sent": ("sent_ts", F.col("sent_ts")),
        "flags": ("flags", flags_text(F.col("flags"))),
        "size": ("size", not_negative(F.col("size"))),
        "message_id": ("message_id", F.expr("coalesce(message_id, '')")),
        "in_reply_to": ("in_reply_to", F.expr(f"coalesce({in_reply_to}, '')")),
    }
    fault_at = _fault_at(df)
    guarded = "header_fault" in df.columns
    columns = []
    for place, field in enumerate(HEADER_ORDER, start=1):
        name, value = shown[field]
        if guarded:
            value = F.when(F.expr(f"{fault_at} NOT BETWEEN 1 AND {place}"), value)
        columns.append(value.alias(name))
    return columns


def project_headers(df: DataFrame, *extra: Column) -> DataFrame:
    """Header columns plus batch, folder and UID; ``extra`` columns are appended."""
    return df.select(*header_columns(df), *_base_columns(df), *extra)


def fetch_rows(
    df: DataFrame, mode: str = FULL_MESSAGE, include_headers: bool = True, *extra: str
) -> DataFrame:
    """Success rows of a fetch: headers or base columns, and content if the mode has it."""
    if mode not in FETCH_MODES:
        raise ValueError(f"fetch mode must be one of {FETCH_MODES}: {mode}")
    more = [F.col(name) for name in (["content"] if mode == FULL_MESSAGE else []) + list(extra)]
    return project_headers(df, *more) if include_headers else project_base(df, *more)


def with_attributes(df: DataFrame, header_fault_at: Column | None = None) -> DataFrame:
    """Projected messages with their string map in column ``attributes``."""
    return df.withColumn("attributes", message_attributes(df.columns, header_fault_at))


def with_batch_id(df: DataFrame, batch_id: str) -> DataFrame:
    """Stamp every row of a run with the same id."""
    return df.withColumn("batch_id", F.lit(batch_id))
