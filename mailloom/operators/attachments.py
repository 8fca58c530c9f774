"""Attachments: from the parts array of a message to rows of their own.

The choice and the caps work on the array inside each row, before the explode,
so nothing is shuffled and no part is carried along that is not kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.functions.text import is_blank, mime_type, not_negative
from mailloom.operators.project import first_sender, header_fault_at, optional
from mailloom.schema import HEADER_ORDER


def _as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def explode_parts(df: DataFrame) -> DataFrame:
    """One row per leaf part, depth first; single-part messages give none."""
    leaves = F.filter("parts", lambda part: ~F.coalesce(part["container"], F.lit(False)))
    return df.select("folder", "uid", F.posexplode(leaves).alias("walk_pos", "part")).select(
        "folder", "uid", "walk_pos", "part.*"
    ).drop("container")


def is_attachment(disposition: Column, filename: Column) -> Column:
    """Marked as attachment, or not marked at all but named."""
    return F.coalesce(F.lower(disposition) == "attachment", filename.isNotNull())


def _within_size(part: Column, max_size) -> Column:
    """True for a part not above the size cap; an unknown size counts as 0."""
    return not_negative(part["size"]) <= _as_column(max_size)


def cap_attachment_size(parts: Column, max_size) -> Column:
    """Parts not above the size cap."""
    return F.filter(parts, lambda part: _within_size(part, max_size))


def until_fault(parts: Column) -> Column:
    """Parts before the first one that cannot be read."""
    faults = F.transform(parts, lambda part: part["fault"].isNotNull())
    first = F.array_position(faults, True)
    return F.when(first > 0, F.slice(parts, F.lit(1), (first - 1).cast("int"))).otherwise(parts)


def cap_attachment_count(parts: Column, max_count) -> Column:
    """The first parts in walk order, across nesting levels."""
    return F.slice(parts, F.lit(1), _as_column(max_count))


def attachment_name(filename: Column, part_index: Column) -> Column:
    return F.coalesce(filename, F.concat(F.lit("attachment_"), part_index.cast("string")))


def candidate_parts(parts: Column, max_size) -> Column:
    """Attachments under the size cap, and containers that cannot be opened.

    Such a container has no size and stops the walk like an unreadable
    attachment; a part above the size cap is passed over unread.
    """
    return F.filter(
        parts,
        lambda part: _within_size(part, max_size) & (
            F.coalesce(part["container"], F.lit(False))
            | is_attachment(part["disposition"], part["filename"])
        ),
    )


def attachment_heads(df: DataFrame) -> dict[str, Column]:
    """What an attachment shows of its message.

    Sender and parent id are missing where the From header could not be read.
    """
    from_read = header_fault_at(df) != HEADER_ORDER.index("from") + 1
    return {
        "parent_message_id": F.when(from_read, F.coalesce("message_id", F.lit(""))),
        "subject": F.coalesce("subject", F.lit("")),
        "sender": F.when(from_read, first_sender(df)),
    }


def attachment_columns(part: Column) -> dict[str, Column]:
    """What an attachment shows of itself."""
    return {
        "part_path": part["part_path"],
        "part_index": part["part_index"],
        "filename": attachment_name(part["filename"], part["part_index"]),
        "mime_type": mime_type(part["content_type"]),
        "size": F.when(part["size"] > 0, part["size"]),
        "content": part["content"],
    }


def kept_parts(candidates: Column, max_count) -> Column:
    """Of the candidate parts, those before a fault and within the count cap."""
    return cap_attachment_count(until_fault(candidates), max_count)


def attachments(df: DataFrame, max_size=2**63 - 1, max_count=2**31 - 1, keep=()) -> DataFrame:
    """One row per kept attachment, linked to its message.

    ``max_size`` and ``max_count`` are numbers or Columns; ``keep`` names more
    columns of ``df`` to carry along.
    """
    candidates = df.withColumn(
        "_parts", candidate_parts(F.col("parts"), max_size)
    ).filter(F.size("_parts") > 0)
    heads = attachment_heads(df)
    exploded = candidates.select(
        "folder",
        "uid",
        *[value.alias(name) for name, value in heads.items()],
        optional(df, "batch_id", "string").alias("batch_id"),
        *keep,
        F.explode(kept_parts(F.col("_parts"), max_count)).alias("part"),
    )
    return exploded.select(
        "folder", "uid", *heads, "batch_id", *keep,
        *[value.alias(name) for name, value in attachment_columns(F.col("part")).items()],
    )


def with_parent(att: DataFrame, messages: DataFrame, *parent_columns: str) -> DataFrame:
    """Attachments with columns of the message they came from.

    The link is the parent Message-ID within the attachment's own folder and
    UID, so a mail copied to many folders does not pair with every copy. Blank
    ids match nothing.
    """
    parents = messages.filter(~is_blank(F.col("message_id"))).select(
        F.col("folder"),
        F.col("uid"),
        F.col("message_id").alias("parent_message_id"),
        *[F.col(name).alias(f"parent_{name}") for name in parent_columns],
    )
    linked = att.filter(~is_blank(F.col("parent_message_id")))
    return linked.join(parents, ["folder", "uid", "parent_message_id"], "inner")
