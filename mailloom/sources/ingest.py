"""The ingest job: landed mails to the message table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from mailloom.schema import MESSAGE
from mailloom.sources.mime import parse_mail

#: Bytes and rows after which a task hands a finished Arrow batch to Spark.
BATCH_BYTES = 4 * 1024 * 1024
BATCH_ROWS = 1024

#: UIDs of a folder that are kept together when a message table is written.
UID_BLOCK = 20_000

_STAMP = pa.timestamp("us", tz="UTC")
_PART = pa.struct([
    ("part_path", pa.list_(pa.int32())),
    ("part_index", pa.int32()),
    ("disposition", pa.string()),
    ("filename", pa.string()),
    ("content_type", pa.string()),
    ("size", pa.int64()),
    ("container", pa.bool_()),
    ("fault", pa.string()),
    ("content", pa.binary()),
])
_MESSAGE = pa.schema([
    ("folder", pa.string()),
    ("uid", pa.int64()),
    ("msg_num", pa.int64()),
    ("received_ts", _STAMP),
    ("size", pa.int64()),
    ("flags", pa.list_(pa.string())),
    ("message_id", pa.string()),
    ("in_reply_to", pa.string()),
    ("subject", pa.string()),
    ("from_all", pa.list_(pa.string())),
    ("sender_all", pa.list_(pa.string())),
    ("to_all", pa.list_(pa.string())),
    ("cc_all", pa.list_(pa.string())),
    ("bcc_all", pa.list_(pa.string())),
    ("sent_ts", _STAMP),
    ("headers", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
    ("header_fault", pa.string()),
    ("content", pa.binary()),
    ("body_fault", pa.string()),
    ("error_message", pa.string()),
    ("parts", pa.list_(_PART)),
])
_LANDED = ("folder", "uid", "msg_num", "received_ts", "size", "flags")


def _record_batch(rows: list[dict]) -> pa.RecordBatch:
    try:
        return pa.RecordBatch.from_pylist(rows, schema=_MESSAGE)
    except (pa.ArrowException, ValueError, TypeError, OverflowError):
        return pa.RecordBatch.from_pylist([_storable(row) for row in rows], schema=_MESSAGE)


def _storable(row: dict) -> dict:
    """The row itself, or an error row if one of its values cannot be stored."""
    try:
        pa.RecordBatch.from_pylist([row], schema=_MESSAGE)
        return row
    except (pa.ArrowException, ValueError, TypeError, OverflowError) as fault:
        return {name: row.get(name) for name in _LANDED} | {"error_message": str(fault)}


def _parse_batches(batches: Iterator[pa.RecordBatch], with_content: bool):
    done: list[dict] = []
    held = 0
    for batch in batches:
        landed = batch.select(list(_LANDED)).to_pylist()
        mails = batch.column("raw")
        for number, row in enumerate(landed):
            raw = mails[number].as_py() or b""
            try:
                row.update(parse_mail(raw, with_content), error_message=None)
            except Exception as fault:  # one unreadable mail must not end the job
                row["error_message"] = str(fault) or type(fault).__name__
            done.append(row)
            held += len(raw)
            if held >= BATCH_BYTES or len(done) >= BATCH_ROWS:
                full, done, held = _record_batch(done), [], 0
                yield full
                del full
    if done:
        yield _record_batch(done)


def ingest(
    raw: DataFrame,
    with_content: bool = True,
    partitions: int | None = None,
    max_message_size: int | None = None,
) -> DataFrame:
    """One message row per landed mail, with its parts.

    Nothing is shuffled unless ``partitions`` asks for it: mails that come in a
    few big splits are then spread by folder and UID before they are parsed.

    A mail that cannot be parsed keeps its folder, UID and size and carries
    ``error_message``. ``with_content=False`` reads headers only. The rows are
    computed again by every action, so write them once with ``write_messages``
    when more than one query follows.

    Mails above ``max_message_size`` are error rows too. Their files are not opened:
    the size comes from the listing.
    """
    present = raw.columns
    landed = raw.select(
        "folder",
        "uid",
        (F.col("msg_num") if "msg_num" in present else F.lit(None).cast("long")).alias("msg_num"),
        "received_ts",
        "size",
        (F.col("flags") if "flags" in present else F.lit(None).cast("array<string>"))
        .alias("flags"),
        "raw",
    )
    above = None
    if max_message_size is not None:
        above = landed.drop("raw").filter(F.col("size") > max_message_size)
        landed = landed.filter(F.col("size").isNull() | (F.col("size") <= max_message_size))
    if partitions is not None:
        landed = landed.repartition(partitions, "folder", "uid")
    parsed = landed.mapInArrow(lambda batches: _parse_batches(batches, with_content), MESSAGE)
    if above is None:
        return parsed
    reason = F.format_string("Message size %d exceeds limit %d", "size", F.lit(max_message_size))
    return parsed.unionByName(above.select(*[
        F.col(f.name) if f.name in _LANDED
        else (reason if f.name == "error_message" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in MESSAGE.fields
    ]))


def write_messages(
    messages: DataFrame,
    path: str,
    partitions: int | None = None,
    clustered: bool = True,
    mode: str = "overwrite",
) -> None:
    """Write a message table, clustered by folder and UID unless told otherwise.

    Messages are grouped by folder and block of UIDs in one pass, so that a big
    folder is spread over many files, and sorted, so that the Parquet scan can
    skip row groups by folder and UID. Mails without a UID are spread by what else
    they have. ``mode="append"`` adds to the table that is there.

    Without ``partitions`` the files follow from bytes: adaptive execution cuts groups
    above ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` (as shuffled) and puts small
    ones together, so a block of large mails becomes several files. It cuts between the
    outputs of the tasks that read the mails, so no file can be smaller than the part of a
    block that one of them gives.
    """
    if clustered:
        other = F.pmod(
            F.xxhash64("msg_num", "message_id", "received_ts", "size", "subject"), F.lit(1024)
        )
        keys = [F.col("folder"), F.coalesce(F.floor(F.col("uid") / UID_BLOCK), -1 - other)]
        if partitions:
            spread = messages.repartition(partitions, *keys)
        else:
            blocks = messages.withColumn("_block", keys[1])
            spread = blocks.hint("rebalance", "folder", "_block").drop("_block")
        messages = spread.sortWithinPartitions("folder", "uid")
    _bloom(messages.write).mode(mode).parquet(path)


def _bloom(writer: DataFrameWriter) -> DataFrameWriter:
    """With bloom filters on Message-IDs, which no order of the rows helps to find."""
    return writer.option("parquet.bloom.filter.enabled#message_id", "true")


def save_messages(
    messages: DataFrame, table: str, buckets: int, path: str | None = None
) -> DataFrame:
    """Save a message table bucketed by folder and UID, and return it.

    Joins on folder and UID (``resolve``, marks, expunge of marked messages) then bring the
    other side to the buckets and leave bodies where they are. Each bucket is one file,
    sorted by folder and UID, and holds messages of all folders, so a folder or UID
    criterion skips row groups and not files. Choose ``buckets`` so that one is about as
    large as a file should be. A table of that name is replaced; ``path`` is where its
    files go, the warehouse by default.
    """
    dealt = messages.repartition(buckets, "folder", "uid").sortWithinPartitions("folder", "uid")
    writer = _bloom(dealt.write).mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, "folder", "uid").sortBy("folder", "uid").saveAsTable(table)
    return messages.sparkSession.table(table)


def parts(messages: DataFrame) -> DataFrame:
    """The ``parts`` table of an ingested message table."""
    from mailloom.operators.attachments import explode_parts

    return explode_parts(messages)


def errors(messages: DataFrame, full_message: bool = True) -> DataFrame:
    """Mails of an ingested table that cannot be delivered, with the reason."""
    reason = F.col("error_message")
    if full_message:
        reason = F.coalesce(reason, F.col("body_fault"))
    return messages.select(
        "folder",
        F.when(F.col("uid") > 0, F.col("uid")).alias("uid"),
        F.lit("MESSAGE_PROCESSING_ERROR").alias("error_type"),
        reason.alias("error_message"),
    ).filter(F.col("error_message").isNotNull())
