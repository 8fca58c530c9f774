"""The poll loop as a stream."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mailloom.operators.cursor import highest_uid
from mailloom.plans.poll import run_step
from mailloom.schema import FetchOptions
from mailloom.sources.sinks import read_cursor_steps, write_cursor_step


def incremental_stream(
    messages: DataFrame,
    out_path: str,
    state_path: str,
    checkpoint: str,
    options: FetchOptions = FetchOptions(incremental=True),
    all_of=(),
    any_of=(),
    trigger: dict | None = None,
    after_batch: Callable[[DataFrame, int], None] | None = None,
    unordered: bool = False,
) -> StreamingQuery:
    """Deliver each new message of a streamed message table once.

    New is what is above the cursor of its folder. That holds only while a folder's
    UIDs come in order, so a source with a rate limit, which offers its files in any
    order, is refused unless ``unordered`` is set. Then new is what no earlier step
    has in its output, by the sets of UIDs that the steps leave beside the cursors, so
    nothing is lost, late mail is delivered too and earlier outputs are never read.

    A replayed micro-batch replaces its own output and its own cursors, so
    nothing is emitted twice. There is no cap per run, because a stream does not
    offer a message again: ``options.batch_size`` has to be left as it is. The three
    paths belong together and must be shared by all executors.
    ``after_batch`` is called with the micro-batch when its outputs are written,
    for instance to mark its messages as read.
    """
    if options.batch_size != FetchOptions.batch_size:
        raise ValueError("a stream has no cap per run; limit the rate of its source")
    if not unordered and rate_limited(messages):
        raise ValueError("files of a source with a rate limit come in no order: set unordered")
    always = replace(options, incremental=True).checked()

    def handle(batch: DataFrame, step: int) -> None:
        batch.persist()
        try:
            run_step(
                batch, step, out_path, state_path, always, all_of, any_of, capped=False,
                unordered=unordered,
            )
            if after_batch is not None:
                after_batch(batch, step)
        finally:
            batch.unpersist()

    return (
        messages.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def rate_limited(messages: DataFrame) -> bool:
    """Whether a file stream was told to offer so many files or bytes at a time."""
    leaves = messages._jdf.queryExecution().analyzed().collectLeaves()
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.nodeName() == "StreamingRelation":
            given = str(leaf.dataSource().options().keySet().mkString(",")).lower().split(",")
            if {"maxfilespertrigger", "maxbytespertrigger"} & set(given):
                return True
    return False


def cursor_stream(
    messages: DataFrame,
    state_path: str,
    checkpoint: str,
    state_folder: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep only the cursors of a streamed message table.

    The highest UID per folder is a streaming aggregate, added up in each task
    before anything is shuffled; every step writes the folders that moved.
    """

    def handle(moved: DataFrame, step: int) -> None:
        known = read_cursor_steps(moved.sparkSession, state_path, before=step)
        reached = moved.withColumn("state_folder", F.lit(state_folder))
        write_cursor_step(reached, known, state_path, step)

    return (
        highest_uid(messages).writeStream.outputMode("update").foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
