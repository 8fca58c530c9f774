"""Many fetch requests in one plan: each row picks its folders and limits."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.functions.attributes import (
    attachment_attributes,
    error_attributes,
    message_attributes,
    request_attributes,
)
from mailloom.operators.attachments import attachments
from mailloom.operators.joins import lookup_join, materialise, measured_bytes, pairs_join
from mailloom.operators.limits import cut_ids, falls_in, id_range, mailbox_id, ranges_of
from mailloom.operators.mailbox import with_marks
from mailloom.operators.project import project_headers, wants_body
from mailloom.operators.requests import (
    classify,
    resolve_folders,
    retry_route,
    route_requests,
    with_defaults,
)
from mailloom.plans.fetch import error_rows, with_outcome
from mailloom.schema import (
    ATTACHMENTS,
    ATTACHMENTS_ONLY,
    FAILURE,
    FULL_MESSAGE,
    HEADERS_ONLY,
    MESSAGE,
    ORIGINAL,
    PARSE_ERROR,
    RETRY,
    SUCCESS,
    FetchOptions,
)
from mailloom.sources.sinks import (
    read_cursor_steps,
    read_mark_steps,
    write_cursor_step,
    write_mark_step,
    write_routes,
)

_HEADER_COLUMNS = [
    "subject", "sender", "to_addr", "cc_addr", "received_ts", "sent_ts", "flags", "size",
    "message_id", "in_reply_to",
]

#: What decides which messages of a folder are candidates and which of them
#: succeed. Requests that agree in all of it share the work, whatever their cap.
_SELECTION = ["folder", "_last_uid", "_body", "max_message_size", "_search"]

#: Selections of a folder that a message meets in one array, on average.
SELECTIONS_A_ROW = 64

#: What else a request asks for.
_DISPLAY = ["request_id", "state_folder", "incremental", "batch_size", "fetch_mode",
            "include_headers", "include_attachments", "max_attachment_size", "max_attachments"]


@dataclass
class Handled:
    """Rows delivered per request, and the requests with the output they go to.

    ``processed`` counts the messages each request found in each folder, before
    cap and errors.
    """

    processed: DataFrame
    success: DataFrame
    attachments: DataFrame
    parse_error: DataFrame
    cursors: DataFrame
    requests: DataFrame | None = None

    def tagged(self) -> DataFrame:
        """All rows of the run in one shape, the requests among them.

        The outputs are success, attachments, parse-error, and for the requests
        themselves retry, failure and original.
        """
        none = F.lit(None)
        # Headers that were not asked for, or could not be read, show no dates.
        unread = (
            F.col("subject").isNull() | F.col("sender").isNull()
            | F.col("to_addr").isNull() | F.col("cc_addr").isNull()
        )
        shown = message_attributes(
            self.success.columns, F.when(unread, F.lit(1)).otherwise(F.lit(0))
        )
        rows = [
            (self.success, F.lit(SUCCESS), F.col("uid"), shown, F.col("content")),
            (self.attachments, F.lit(ATTACHMENTS), F.col("uid"), attachment_attributes(),
             F.col("content")),
            (self.parse_error, F.lit(PARSE_ERROR), F.col("uid"), error_attributes(), none),
        ]
        if self.requests is not None:
            rows.append((
                self.requests, F.col("relationship"), none, request_attributes(), none
            ))
        shaped = [
            df.select(
                output.alias("relationship"), "request_id", "folder",
                uid.cast("bigint").alias("uid"), attributes.alias("attributes"),
                content.cast("binary").alias("content"),
            )
            for df, output, uid, attributes, content in rows
        ]
        return reduce(DataFrame.unionByName, shaped)


def _targets(requests: DataFrame, folders: DataFrame, cursors: DataFrame | None) -> DataFrame:
    """(request, folder) pairs with the request's options and the folder's cursor."""
    search = F.col("search") if "search" in requests.columns else F.lit("")
    asked = requests.withColumns({
        "_search": F.coalesce(search, F.lit("")), "_body": wants_body(F.col("fetch_mode")),
    })
    pairs = resolve_folders(
        asked, folders, keep=[*_DISPLAY[1:], "_body", "max_message_size", "_search", "target"]
    )
    pairs = pairs.withColumn("state_folder", F.coalesce("state_folder", "target")).drop("target")
    if cursors is None:
        return pairs.withColumn("_last_uid", F.lit(-1).cast("long"))
    last = cursors.filter(F.col("last_uid") >= 0).select("state_folder", "folder", "last_uid")
    joined = lookup_join(pairs, last, ["state_folder", "folder"], spread=["request_id"])
    return joined.withColumn(
        "_last_uid",
        F.when(F.col("incremental"), F.coalesce("last_uid", F.lit(-1))).otherwise(F.lit(-1))
        .cast("long"),
    ).drop("last_uid")


def _selected(
    messages: DataFrame,
    entries: DataFrame,
    searches: dict[str, Column] | None,
    ident: list[str],
    slices: int,
    known_bytes: int,
    keep: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Messages with each of ``entries`` that selects them, and with their outcome.

    ``entries`` are selections, with further columns that ``keep`` tests against the id of a
    message. Those of a folder are dealt out over ``slices`` arrays; all together have at most
    ``known_bytes``.
    """
    columns = [name for name in entries.columns if name != "folder"]
    arrays = entries.groupBy(
        "folder", F.pmod(F.xxhash64(*columns), F.lit(slices)).alias("_slice")
    ).agg(F.collect_list(F.struct(*columns)).alias("_entries")).drop("_slice")

    hits = [F.lit("")] + [F.when(is_met, F.lit(name)) for name, is_met in (searches or {}).items()]
    searched = messages.withColumns({
        "_hits": F.array_compact(F.array(*hits)), "_ident": mailbox_id(messages),
    })
    met = lookup_join(
        searched, arrays, ["folder"], "inner", spread=ident, known_bytes=known_bytes
    )
    row_id = F.col("_ident")

    def selects(s: Column) -> Column:
        wanted = F.array_contains("_hits", s["_search"]) & (
            (s["_last_uid"] < 0) | (row_id > s["_last_uid"])
        )
        return wanted & keep(s, row_id) if keep else wanted

    found = met.select(
        *messages.columns, F.explode(F.filter("_entries", selects)).alias("_entry")
    ).select(*messages.columns, "_entry.*")
    mode = F.when(F.col("_body"), F.lit(FULL_MESSAGE)).otherwise(F.lit(HEADERS_ONLY))
    return with_outcome(found, F.col("max_message_size"), mode)


def _counted(selected: DataFrame) -> DataFrame:
    """Per selection and range of ids the messages found, and those that succeed."""
    return selected.groupBy(*_SELECTION, id_range(mailbox_id(selected)).alias("_range")).agg(
        F.count(F.lit(1)).alias("_found"),
        F.count(F.when(F.col("relationship") == SUCCESS, F.lit(1))).alias("_n"),
    )


def fetch_for_requests(
    requests: DataFrame,
    folders: DataFrame,
    messages: DataFrame,
    cursors: DataFrame | None = None,
    searches: dict[str, Column] | None = None,
    batch_id: str | None = None,
) -> Handled:
    """Messages for every request at once; request options are filled in.

    Requests are resolved to folders on the small folder table. A message meets the
    distinct selections of its folder as an array and tests them in its row. What they
    select is counted per range of ids, the ranges where caps fall are counted per id, and
    only then the messages within the caps are taken, with their content, and written once.
    So what goes through a shuffle are sums, and the rows that some request is given; these
    meet the requests in cells (``pairs_join``), so that no task has more than its share of
    what is delivered, however few files the messages are in. ``searches`` are named criteria
    that a request can choose in its ``search`` column. A request with an unknown name gets
    no messages and is a failure in ``requests``.
    """
    lost = None
    if "search" in requests.columns:
        lost = requests.filter(unknown_search(searches)).withColumns({
            "relationship": F.lit(FAILURE), "error_type": F.lit("FILTER_PARSE_ERROR"),
            "error_message": F.concat(F.lit("unknown search: "), F.col("search")),
        })
    targets = materialise(_targets(requests, folders, cursors))
    ident = [name for name in ("uid", "msg_num") if name in messages.columns]
    named = searches if "search" in requests.columns else None
    selections = targets.select(*_SELECTION).distinct()
    most = selections.groupBy("folder").count().agg(F.max("count")).first()[0] or 1
    caps = targets.select(*_SELECTION, "batch_size").distinct().withColumn(
        "_cap", (F.col("batch_size") * FetchOptions.BATCHES_PER_RUN).cast("long")
    )
    # No pass has more entries than there are selections with a cap, or two numbers more in each.
    many = {"slices": -(-most // SELECTIONS_A_ROW), "known_bytes": 2 * measured_bytes(caps)}
    counts = materialise(_counted(_selected(messages, selections, named, ident, **many)))
    ranges = ranges_of(counts.filter("_n > 0").drop("_found"), _SELECTION)
    falls = falls_in(ranges.join(caps.drop("batch_size"), _SELECTION))
    inside = _selected(
        messages, falls, named, ident, **many,
        keep=lambda s, ident: s["_range"] == id_range(ident),
    ).filter(F.col("relationship") == SUCCESS).withColumn("_id", mailbox_id(messages))
    caps = materialise(
        caps.join(cut_ids(inside, _SELECTION), [*_SELECTION, "_cap"], "left").drop("_cap")
    )
    # The furthest any request goes, or to the end where one meets no cap.
    furthest = caps.groupBy(*_SELECTION).agg(
        F.when(F.count("_cap_id") == F.count(F.lit(1)), F.max("_cap_id")).alias("_bound")
    )
    reached = _selected(
        messages, furthest, named, ident, **many,
        keep=lambda s, ident: s["_bound"].isNull() | (ident <= s["_bound"]),
    ).drop("_bound").withColumn("batch_id", F.lit(batch_id).cast("string"))
    weight = F.lit(0)
    if "content" in messages.columns:
        reached = reached.withColumn("content", F.when(F.col("_body"), F.col("content")))
        weight = F.coalesce(F.octet_length("content"), F.lit(0))
    reached = materialise(reached)
    asked = materialise(lookup_join(
        targets.select(*_DISPLAY, *_SELECTION), caps, [*_SELECTION, "batch_size"],
        spread=["request_id"],
    ))
    routed = pairs_join(
        reached, asked, _SELECTION, ident, ["request_id"], weight
    ).filter(
        F.col("_cap_id").isNull() | (mailbox_id(messages) <= F.col("_cap_id"))
    ).drop("_cap_id")
    found = counts.groupBy(*_SELECTION).agg(F.sum("_found").alias("processed"))
    processed = targets.join(found, _SELECTION, "inner").select(
        "request_id", "folder", "processed"
    )

    delivered = routed.filter(F.col("relationship") == SUCCESS)
    body = F.col("content") if "content" in routed.columns else F.lit(None).cast("binary")
    shown = project_headers(
        delivered,
        F.col("request_id"),
        F.col("include_headers"),
        F.when(wants_body(F.col("fetch_mode")), body).alias("content"),
    )
    success = shown.withColumns({
        name: F.when(F.col("include_headers"), F.col(name)) for name in _HEADER_COLUMNS
    }).drop("include_headers")

    files = delivered.filter(
        (F.col("fetch_mode") == ATTACHMENTS_ONLY)
        | (wants_body(F.col("fetch_mode")) & F.col("include_attachments"))
    )
    if "parts" not in files.columns:
        files = files.withColumn("parts", F.lit(None).cast(MESSAGE["parts"].dataType))
    moved = delivered.filter(F.col("uid") > 0).filter(F.col("incremental"))
    return Handled(
        processed=processed,
        success=success,
        attachments=attachments(
            files, F.col("max_attachment_size"), F.col("max_attachments"), keep=("request_id",)
        ),
        parse_error=error_rows(routed.filter(F.col("relationship") == PARSE_ERROR), "request_id"),
        cursors=moved.groupBy("state_folder", "folder").agg(F.max("uid").alias("last_uid")),
        requests=lost,
    )


def unknown_search(searches: dict[str, Column] | None) -> Column:
    """True for a request whose search, which may be empty, has no criteria."""
    named = F.coalesce("search", F.lit("")) != ""
    return named & ~F.col("search").isin(list(searches or {})) if searches else named


def settle_requests(
    requests: DataFrame,
    folders: DataFrame,
    now_ms: int,
    faults: DataFrame | None = None,
    searches: dict[str, Column] | None = None,
) -> DataFrame:
    """Requests, options filled in, with the output they go to and why.

    ``faults`` (``request_id``, ``kind``, ``message``) are problems met while a
    request was carried out. A request for one folder that does not exist
    counts as such a problem. Those in ``original`` are to be carried out,
    those in ``retry`` are the requests of a later run.
    """
    gated = route_requests(with_defaults(requests), now_ms)
    if "search" in gated.columns:
        unknown = (F.col("relationship") == ORIGINAL) & unknown_search(searches)
        gated = gated.withColumns({
            "error_type": F.when(unknown, F.lit("FILTER_PARSE_ERROR"))
            .otherwise(F.col("error_type")),
            "error_message": F.when(
                unknown, F.concat(F.lit("unknown search: "), F.col("search"))
            ).otherwise(F.col("error_message")),
            "relationship": F.when(unknown, F.lit(FAILURE)).otherwise(F.col("relationship")),
        })
    ready = gated.filter(F.col("relationship") == ORIGINAL)

    known = folders.select(F.col("path").alias("folder"))
    lost = lookup_join(
        ready.filter(~F.col("recursive")), known, ["folder"], "left_anti", spread=["request_id"]
    )
    problems = lost.select(
        "request_id",
        F.lit("messaging").alias("kind"),
        F.concat("folder", F.lit(" not found")).alias("message"),
    )
    if faults is not None:
        reported = faults.select("request_id", "kind", "message")
        problems = problems.join(reported, "request_id", "left_anti").unionByName(reported)
    problems = materialise(problems)
    failed = retry_route(ready.drop("relationship"), classify(problems), now_ms)
    return (
        gated.filter(F.col("relationship") != ORIGINAL)
        .unionByName(failed.drop("backoff_ms").select(*gated.columns))
        .unionByName(ready.join(problems, "request_id", "left_anti").select(*gated.columns))
    )


def run_requests(
    requests: DataFrame,
    folders: DataFrame,
    messages: DataFrame,
    now_ms: int,
    cursors: DataFrame | None = None,
    faults: DataFrame | None = None,
    searches: dict[str, Column] | None = None,
    batch_id: str | None = None,
) -> Handled:
    """Settle requests and carry out those that are ready."""
    settled = materialise(settle_requests(requests, folders, now_ms, faults, searches))
    ready = settled.filter(F.col("relationship") == ORIGINAL)
    handled = fetch_for_requests(ready, folders, messages, cursors, searches, batch_id)
    handled.requests = settled
    return handled


def run_request_step(
    requests: DataFrame,
    folders: DataFrame,
    messages: DataFrame,
    step: int,
    out_path: str,
    state_path: str,
    now_ms: int,
    faults: DataFrame | None = None,
    searches: dict[str, Column] | None = None,
) -> Handled:
    """One run over requests with its results on disk.

    All outputs are written first, then the cursors reached and the marks set, then
    the requests that go round again (``read_next_requests``). The step reads what the
    steps before it left and replaces its own results, so it can be run again after a
    failure. Requests can have the columns ``mark_read`` and ``delete_messages``.
    """
    spark = messages.sparkSession
    known = read_cursor_steps(spark, state_path, before=step)
    wants = [name for name in ("mark_read", "delete_messages") if name in requests.columns]
    if wants and step > 0:
        messages = with_marks(messages, read_mark_steps(spark, state_path, before=step))
    handled = run_requests(
        requests, folders, messages, now_ms, known, faults, searches, f"requests-{step}"
    )
    written = f"{out_path.rstrip('/')}/step={step}"
    write_routes(handled.tagged(), written)

    given = handled.requests
    # A column of its own: the rules that hold for the ids of ``given`` would otherwise be
    # taken over as filters on every delivered row.
    asked = given.select(
        F.col("request_id").bitwiseOR(F.lit(0)).alias("request_id"),
        F.coalesce("state_folder", "folder").alias("state_folder"), "incremental",
        *[F.coalesce(F.col(name), F.lit(False)).alias(name) for name in wants],
    )
    delivered = spark.read.schema(
        "request_id bigint, folder string, uid bigint, relationship string"
    ).parquet(written).filter((F.col("relationship") == SUCCESS) & (F.col("uid") > 0))
    delivered = lookup_join(
        delivered.select("request_id", "folder", "uid"), asked, ["request_id"], "inner",
        spread=["folder", "uid"],
    )
    reached = delivered.filter("incremental").groupBy("state_folder", "folder").agg(
        F.max("uid").alias("last_uid")
    )
    write_cursor_step(reached, known, state_path, step)
    if wants:
        set_by = {name: F.col(name) if name in wants else F.lit(False)
                  for name in ("mark_read", "delete_messages")}
        write_mark_step(
            delivered.filter(set_by["mark_read"] | set_by["delete_messages"]),
            state_path, step, set_by["mark_read"], set_by["delete_messages"],
        )
    given.filter(F.col("relationship") == RETRY).write.mode("overwrite").parquet(
        _requests_path(state_path, step)
    )
    return handled


def read_next_requests(spark, state_path: str, step: int) -> DataFrame:
    """The requests that a step left for a later run."""
    kept = spark.read.parquet(_requests_path(state_path, step))
    return kept.drop("relationship", "error_type", "error_message")


def _requests_path(state_path: str, step: int) -> str:
    return f"{state_path.rstrip('/')}/requests/step={step}"
