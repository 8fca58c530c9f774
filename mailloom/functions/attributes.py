"""Rows rendered as string maps under the published attribute names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailloom.functions.text import epoch_millis_text

# Attribute names of a message, with the column each one shows.
MESSAGE_ATTRIBUTES = {
    "email.subject": "subject",
    "email.from": "sender",
    "email.to": "to_addr",
    "email.cc": "cc_addr",
    "email.received.date": "received_ts",
    "email.sent.date": "sent_ts",
    "email.flags": "flags",
    "email.size": "size",
    "email.message.id": "message_id",
    "email.in.reply.to": "in_reply_to",
    "email.batch.id": "batch_id",
    "email.folder": "folder",
    "email.uid": "uid",
}

# Attribute names of an attachment.
ATTACHMENT_ATTRIBUTES = {
    "attachment.filename": "filename",
    "attachment.mime.type": "mime_type",
    "email.folder": "folder",
    "attachment.size": "size",
    "email.subject": "subject",
    "email.from": "sender",
    "email.parent.message.id": "parent_message_id",
    "email.batch.id": "batch_id",
}

# Attribute names of an error row.
ERROR_ATTRIBUTES = {
    "error.type": "error_type",
    "error.message": "error_message",
    "email.folder": "folder",
    "email.uid": "uid",
}

# Attribute names a request carries on its way out.
REQUEST_ATTRIBUTES = {
    "retry.count": "retry_count",
    "retry.last.time": "retry_last_time_ms",
    "error.type": "error_type",
    "error.message": "error_message",
}


def _as_map(pairs: list[tuple[str, Column]]) -> Column:
    cells = [cell for name, value in pairs for cell in (F.lit(name), value.cast("string"))]
    return F.map_filter(F.create_map(*cells), lambda _, value: value.isNotNull())


def _columns_as_map(columns: dict[str, str]) -> Column:
    return _as_map([(name, F.col(column)) for name, column in columns.items()])


def message_attributes(columns: list[str], header_fault_at: Column | None = None) -> Column:
    """Map of a projected message; ``columns`` are the columns it really has.

    A missing date is the empty text, other missing values are left out. Where
    reading the headers stopped, ``header_fault_at`` is the 1-based place of the
    first unread header, and a date past it is left out as well.
    """
    pairs = []
    for name, column in MESSAGE_ATTRIBUTES.items():
        if column not in columns:
            continue
        value = F.col(column)
        if column in ("received_ts", "sent_ts"):
            value = epoch_millis_text(value)
            if header_fault_at is not None:
                place = {"received_ts": 5, "sent_ts": 6}[column]
                value = F.when(~header_fault_at.between(1, place), value)
        pairs.append((name, value))
    return _as_map(pairs)


def attachment_attributes(values: dict[str, Column] | None = None) -> Column:
    """Map of an attachment row; a missing size is ``unknown``.

    ``values`` stand in for columns that are named otherwise.
    """
    pairs = []
    for name, column in ATTACHMENT_ATTRIBUTES.items():
        value = (values or {}).get(column, F.col(column))
        if column == "size":
            value = F.coalesce(value.cast("string"), F.lit("unknown"))
        pairs.append((name, value))
    return _as_map(pairs)


def error_attributes() -> Column:
    """Map of an error row."""
    return _columns_as_map(ERROR_ATTRIBUTES)


def request_attributes() -> Column:
    """Map of a request on its way out."""
    return _columns_as_map(REQUEST_ATTRIBUTES)
