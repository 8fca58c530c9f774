"""One run over a mailbox: select, cap, split by outcome, show."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from mailloom.functions.attributes import (
    MESSAGE_ATTRIBUTES,
    attachment_attributes,
    error_attributes,
    message_attributes,
)
from mailloom.functions.text import not_negative
from mailloom.operators import criteria
from mailloom.operators.attachments import (
    attachment_columns,
    attachment_heads,
    attachments,
    candidate_parts,
    kept_parts,
)
from mailloom.operators.cursor import after_cursor, highest_uid
from mailloom.operators.folders import in_folder, reachable_folders
from mailloom.operators.joins import lookup_join
from mailloom.operators.limits import cap_per_folder
from mailloom.operators.project import (
    fetch_rows,
    header_columns,
    header_fault_at,
    optional,
    wants_body,
    with_batch_id,
)
from mailloom.operators.summary import run_summary
from mailloom.schema import (
    ATTACHMENTS,
    ATTACHMENTS_ONLY,
    FULL_MESSAGE,
    HEADERS_ONLY,
    MESSAGE,
    PARSE_ERROR,
    PART,
    SUCCESS,
    FetchOptions,
)


def within_limit(max_message_size: int) -> Column:
    """Size test as plain comparisons, which the Parquet scan understands."""
    return F.col("size").isNull() | (F.col("size") <= max_message_size)


def with_outcome(df: DataFrame, max_message_size, mode=FULL_MESSAGE) -> DataFrame:
    """Messages with ``relationship``, ``error_type`` and ``error_message``.

    Oversize is tested first; then a mail that could not be parsed, or whose
    body could not be decoded while the body is wanted, is an error. Size limit
    and mode are values or Columns.
    """
    limit = max_message_size if isinstance(max_message_size, Column) else F.lit(max_message_size)
    mode = mode if isinstance(mode, Column) else F.lit(mode)
    size = not_negative(F.col("size"))
    reason = F.lit(None).cast("string")
    if "body_fault" in df.columns:
        reason = F.when(wants_body(mode), F.col("body_fault"))
    if "error_message" in df.columns:
        reason = F.coalesce(F.col("error_message"), reason)
    too_large = size > limit
    return df.withColumns({
        "error_type": F.when(too_large, F.lit("MESSAGE_TOO_LARGE"))
        .when(reason.isNotNull(), F.lit("MESSAGE_PROCESSING_ERROR")),
        "error_message": F.when(
            too_large, F.format_string("Message size %d exceeds limit %d", size, limit)
        ).otherwise(reason),
        "relationship": F.when(too_large | reason.isNotNull(), F.lit(PARSE_ERROR))
        .otherwise(F.lit(SUCCESS)),
    })


def split_oversize(df: DataFrame, max_message_size: int) -> tuple[DataFrame, DataFrame]:
    """Messages within the size limit, and error rows for the others."""
    routed = with_outcome(df, max_message_size, HEADERS_ONLY)
    within = df.filter(within_limit(max_message_size))
    return within, error_rows(routed.filter(F.col("size") > max_message_size))


def error_rows(routed: DataFrame, *extra: str) -> DataFrame:
    return routed.select(
        *extra,
        "folder",
        F.when(F.col("uid") > 0, F.col("uid")).alias("uid"),
        "error_type",
        "error_message",
    )


@dataclass
class Fetched:
    """Outputs of a run. ``candidates`` are the messages before cap and errors."""

    options: FetchOptions
    candidates: DataFrame
    routed: DataFrame
    success: DataFrame
    attachments: DataFrame
    parse_error: DataFrame
    seen: Observation | None = None

    @property
    def processed(self) -> int:
        """Messages before cap and errors, counted while an output of the run was computed.

        Nothing runs for it: it is known once an output was written, and waits until then.
        Only an ``observed`` run has it. A part of the selection that is computed again for
        a lost executor may be counted again; ``summary`` is exact.
        """
        if self.seen is None:
            raise ValueError("the run was not observed")
        return self.seen.get["processed"]

    @property
    def cursors(self) -> DataFrame:
        """Highest delivered UID of each folder."""
        return highest_uid(self.success)

    @property
    def summary(self) -> DataFrame:
        return run_summary(self.candidates)

    def tagged(self) -> DataFrame:
        """All rows of the run in one shape: output, attributes and content.

        One pass over the messages: each gives its own row, followed by the
        rows of its attachments.
        """
        routed, part = self.routed, F.col("part")
        success = F.col("relationship") == SUCCESS
        body = F.lit(None).cast("binary")
        if self.options.fetch_mode == FULL_MESSAGE and "content" in routed.columns:
            body = F.when(success, F.col("content"))
        itself = F.struct(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in PART.fields[:-1]],
            body.alias("content"),
        )
        rows = F.array(itself)
        if _wants_files(self.options) and "parts" in routed.columns:
            max_size, max_count = _file_limits(self.options)
            candidates = F.when(success, candidate_parts(F.col("parts"), max_size))
            routed = routed.withColumn(
                "_parts", F.coalesce(candidates, F.array().cast(MESSAGE["parts"].dataType))
            )
            rows = F.concat(rows, kept_parts(F.col("_parts"), max_count))

        columns = {"batch_id": optional(routed, "batch_id", "string"), "folder": F.col("folder"),
                   "uid": F.when(F.col("uid") > 0, F.col("uid"))}
        heads = attachment_heads(routed)
        shown = list(columns)
        headers = header_columns(routed) if self.options.include_headers else []
        exploded = routed.select(
            *headers,
            *[value.alias(name) for name, value in columns.items()],
            *[value.alias(f"_{name}") for name, value in heads.items()],
            "relationship", "error_type", "error_message",
            header_fault_at(routed).alias("_fault_at"),
            F.posexplode(rows).alias("_pos", "part"),
        )
        if headers:
            shown += MESSAGE_ATTRIBUTES.values()
        of_file = attachment_columns(part) | {name: F.col(f"_{name}") for name in heads}
        is_file = F.col("_pos") > 0
        return exploded.select(
            F.when(is_file, F.lit(ATTACHMENTS)).otherwise(F.col("relationship"))
            .alias("relationship"),
            "folder",
            "uid",
            F.when(is_file, attachment_attributes(of_file))
            .when(success, message_attributes(shown, F.col("_fault_at")))
            .otherwise(error_attributes()).alias("attributes"),
            part["content"].alias("content"),
        )


def _wants_files(options: FetchOptions) -> bool:
    return options.fetch_mode == ATTACHMENTS_ONLY or (
        options.fetch_mode == FULL_MESSAGE and options.include_attachments
    )


def _file_limits(options: FetchOptions) -> tuple[int, int]:
    """Attachment limits; they apply only where attachments were asked for."""
    if options.include_attachments:
        return options.max_attachment_size, options.max_attachments
    return 2**63 - 1, 2**31 - 1


def select_candidates(
    messages: DataFrame,
    options: FetchOptions,
    all_of=(),
    any_of=(),
    cursors: DataFrame | dict[str, int] | None = None,
    folders: DataFrame | None = None,
) -> DataFrame:
    """Messages of the chosen folders that meet the criteria and are new.

    With a ``folders`` table, a recursive run also leaves out folders that
    cannot be reached.
    """
    chosen = in_folder(
        messages, options.folder, options.recursive, options.max_recursion_depth
    )
    if options.recursive and folders is not None:
        reached = in_folder(
            reachable_folders(folders), options.folder, True, options.max_recursion_depth, "path"
        ).select(F.col("path").alias("folder"))
        chosen = lookup_join(
            chosen, reached, ["folder"], "left_semi", spread=["uid"], computed=True
        )
    found = criteria.search(chosen, all_of, any_of)
    if cursors is None or not options.incremental:
        return found
    state = None if isinstance(cursors, dict) else options.state_key_base
    return after_cursor(found, cursors, state)


def fetch(
    messages: DataFrame,
    options: FetchOptions = FetchOptions(),
    all_of=(),
    any_of=(),
    cursors: DataFrame | dict[str, int] | None = None,
    folders: DataFrame | None = None,
    batch_id: str | None = None,
    capped: bool = True,
    observed: bool = False,
) -> Fetched:
    """One run: the outputs for the messages selected by options and criteria.

    The size test reads no body, the outputs read only the columns they show.
    Options that break a rule raise an error. With ``observed`` the candidates are counted
    on the way (``Fetched.processed``); a cap is found by jobs of its own over them, so a
    capped run cannot be observed.
    """
    options.checked()
    if batch_id is not None:
        messages = with_batch_id(messages, batch_id)
    candidates = select_candidates(messages, options, all_of, any_of, cursors, folders)
    if observed and capped:
        raise ValueError("a run with a cap is not observed: use its summary")
    seen = Observation() if observed else None
    if seen is not None:
        candidates = candidates.observe(seen, F.count(F.lit(1)).alias("processed"))
    routed = with_outcome(candidates, options.max_message_size, options.fetch_mode)
    if capped:
        routed = cap_per_folder(
            routed, options.batch_size,
            within_limit(options.max_message_size) & (F.col("relationship") == SUCCESS),
        )
    delivered = routed.filter(
        within_limit(options.max_message_size) & (F.col("relationship") == SUCCESS)
    )
    with_files = delivered
    if "parts" not in delivered.columns:
        with_files = delivered.withColumn("parts", F.lit(None).cast(MESSAGE["parts"].dataType))
    if not _wants_files(options):
        with_files = with_files.filter(F.lit(False))
    return Fetched(
        options=options,
        candidates=candidates,
        routed=routed,
        success=fetch_rows(delivered, options.fetch_mode, options.include_headers),
        attachments=attachments(with_files, *_file_limits(options)),
        parse_error=error_rows(routed.filter(F.col("relationship") == PARSE_ERROR)),
        seen=seen,
    )
