"""A poll of a mailbox table: fetch what is new, then move cursors and flags."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.operators.cursor import advance_cursor, highest_uid
from mailloom.operators.mailbox import expunge, flag_deleted, mark_read, with_marks
from mailloom.plans.fetch import Fetched, fetch
from mailloom.schema import FetchOptions
from mailloom.sources.sinks import (
    delivered_keys,
    not_delivered,
    read_cursor_steps,
    read_mark_steps,
    write_cursor_step,
    write_delivered_step,
    write_mark_step,
    write_routes,
)


@dataclass
class Polled:
    fetched: Fetched
    cursors: DataFrame
    mailbox: DataFrame


def update_mailbox(messages: DataFrame, done: DataFrame, options: FetchOptions) -> DataFrame:
    """The message table after the run: read marks, delete marks, expunge."""
    if options.mark_read:
        messages = mark_read(messages, done)
    if options.delete_messages:
        messages = expunge(flag_deleted(messages, done), done)
    return messages


def poll(
    messages: DataFrame,
    cursors: DataFrame,
    options: FetchOptions = FetchOptions(),
    all_of=(),
    any_of=(),
    folders: DataFrame | None = None,
    batch_id: str | None = None,
) -> Polled:
    """One trigger. Write the three results, in this order, to complete it."""
    fetched = fetch(messages, options, all_of, any_of, cursors, folders, batch_id)
    return Polled(
        fetched,
        advance_cursor(
            cursors, fetched.cursors, options.state_key_base, options.incremental
        ),
        update_mailbox(messages, fetched.success, options),
    )


def run_step(
    messages: DataFrame,
    step: int,
    out_path: str,
    state_path: str,
    options: FetchOptions = FetchOptions(incremental=True),
    all_of=(),
    any_of=(),
    folders: DataFrame | None = None,
    capped: bool = True,
    unordered: bool = False,
) -> Fetched:
    """One trigger with its results on disk: outputs first, then the cursors reached.

    The step reads the cursors of the steps before it and replaces its own
    output, its own cursors and its own marks, so it can be run again after a failure.
    Read and delete marks go to a log beside the cursors; a step with such options sees
    the messages as the marks of the steps before it leave them. With
    ``unordered`` the messages that earlier steps have in their output are left out,
    whatever the cursors say; a log of their UIDs beside the cursors tells, and has to be
    kept from the first step on. Only the latest step can be run again.
    Without a cap ``processed`` of the result is the number of messages that were new;
    ``step_counts`` gives what the outputs hold per folder. Neither selects again.
    """
    options.checked()
    state = options.state_key_base
    known = None
    if options.incremental:
        known = read_cursor_steps(messages.sparkSession, state_path, before=step)
    marking = options.mark_read or options.delete_messages
    if marking and step > 0:
        messages = with_marks(
            messages, read_mark_steps(messages.sparkSession, state_path, before=step)
        )
    if unordered:
        messages = not_delivered(messages, state_path, step)
    fetched = fetch(
        messages, options, all_of, any_of, None if unordered else known, folders,
        f"{state}-{step}", capped, observed=not capped,
    )
    written = f"{out_path.rstrip('/')}/step={step}"
    write_routes(fetched.tagged(), written)
    if unordered:
        keys = messages.sparkSession.read.schema("folder string, uid bigint").parquet(written)
        write_delivered_step(keys, state_path, step)
    # Cursors and marks follow from the keys that were written; nothing runs again.
    delivered = delivered_keys(messages.sparkSession, written)
    if options.incremental:
        reached = highest_uid(delivered).withColumn("state_folder", F.lit(state))
        write_cursor_step(reached, known, state_path, step)
    if marking:
        write_mark_step(
            delivered, state_path, step, options.mark_read, options.delete_messages
        )
    return fetched
