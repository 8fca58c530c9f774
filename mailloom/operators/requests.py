"""Fetch requests as a table: defaults, validation, retry gate and routing.

Times are parameters: ``now_ms`` is the run's clock, so that a plan gives the
same rows whenever it is run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.functions.text import capped_product, default_if_missing, power_of_two
from mailloom.operators.folders import folder_depth, reachable_folders
from mailloom.operators.joins import lookup_join
from mailloom.schema import FAILURE, ORIGINAL, RETRY, FetchOptions

_LONG_MAX = 2**63 - 1
_INT_MAX = 2**31 - 1


def with_defaults(requests: DataFrame, defaults: FetchOptions = FetchOptions()) -> DataFrame:
    """Requests with every missing option filled in.

    Without attachments their limits do not apply and are set to the maximum.
    """
    columns: dict[str, Column] = {}
    for name in (
        "folder", "recursive", "max_recursion_depth", "state_folder", "batch_size",
        "fetch_mode", "include_headers", "include_attachments", "incremental",
        "max_message_size", "max_retries", "retry_backoff_ms",
    ):
        value = getattr(defaults, name)
        if name not in requests.columns:
            columns[name] = F.lit(value)
        elif value is not None:
            default = F.lit(value).cast(requests.schema[name].dataType)
            columns[name] = default_if_missing(F.col(name), default)
    wanted = columns["include_attachments"]
    for name, off, kind in (
        ("max_attachment_size", _LONG_MAX, "long"), ("max_attachments", _INT_MAX, "int"),
    ):
        value = F.lit(getattr(defaults, name)).cast(kind)
        if name in requests.columns:
            value = default_if_missing(F.col(name).cast(kind), value)
        columns[name] = F.when(wanted, value).otherwise(F.lit(off).cast(kind))
    return requests.withColumns(columns)


def retry_wait_ms() -> Column:
    """Wait demanded of a request that was retried ``retry_count`` times."""
    return capped_product(F.col("retry_backoff_ms"), power_of_two(F.col("retry_count") - 1))


def retry_ready(requests: DataFrame, now_ms: int) -> DataFrame:
    """Requests with column ``ready``: false while their wait is not over."""
    held = (
        F.col("retry_count").isNotNull()
        & F.col("retry_last_time_ms").isNotNull()
        & (F.coalesce(
            F.try_subtract(F.lit(now_ms), F.col("retry_last_time_ms")), F.lit(_LONG_MAX)
        ) < retry_wait_ms())
    )
    return requests.withColumn("ready", ~F.coalesce(held, F.lit(False)))


def next_backoff() -> Column:
    """Wait that follows the next retry."""
    return capped_product(
        F.col("retry_backoff_ms"), power_of_two(F.coalesce("retry_count", F.lit(0)))
    )


# Rules in the order in which they are tested, with the error type
# and the text of a request that breaks them.
_RULES = [
    ("coalesce(trim(folder), '') = ''", "INVALID_FOLDER", "folder cannot be empty"),
    ("batch_size <= 0", "INVALID_BATCH_SIZE", "batch size must be positive"),
    ("max_message_size <= 0", "INVALID_MAX_MESSAGE_SIZE", "Max message size must be positive"),
    ("include_attachments AND max_attachment_size <= 0",
     "INVALID_MAX_ATTACHMENT_SIZE", "Max attachment size must be positive"),
    ("include_attachments AND max_attachment_size > max_message_size",
     "INVALID_SIZE_LIMITS", "Max attachment size cannot exceed max message size"),
    ("include_attachments AND max_attachments <= 0",
     "INVALID_MAX_ATTACHMENTS", "Max attachments per message must be positive"),
    ("max_retries < 0", "INVALID_MAX_RETRIES", "Max retries must be non-negative"),
    ("retry_backoff_ms <= 0", "INVALID_RETRY_BACKOFF", "Retry backoff must be positive"),
    ("fetch_mode = 'ATTACHMENTS_ONLY' AND NOT include_attachments", "INVALID_FETCH_MODE",
     "attachments alone cannot be fetched while attachments are left out"),
    ("max_recursion_depth < -1 OR max_recursion_depth = 0", "INVALID_MAX_RECURSION_DEPTH",
     "recursion depth has to be positive, or -1 for any depth"),
]


def validate_requests(requests: DataFrame) -> DataFrame:
    """Requests with the first rule they break; both columns are NULL if none."""
    broken = F.lit(None).cast("struct<kind:string,text:string>")
    for condition, kind, text in reversed(_RULES):
        rule = F.struct(F.lit(kind).alias("kind"), F.lit(text).alias("text"))
        broken = F.when(F.expr(condition), rule).otherwise(broken)
    return requests.withColumn("_broken", broken).withColumns({
        "error_type": F.col("_broken.kind"), "error_message": F.col("_broken.text"),
    }).drop("_broken")


def classify(faults: DataFrame) -> DataFrame:
    """Faults (``kind``, ``message``) with error type and the output they go to."""
    mail = F.coalesce(F.col("kind") == "messaging", F.lit(False))
    return faults.withColumns({
        "error_type": F.when(mail, "CONNECTION_ERROR").otherwise("UNEXPECTED_ERROR"),
        "error_message": F.col("message"),
        "relationship": F.when(mail, RETRY).otherwise(FAILURE),
    })


def retry_route(requests: DataFrame, errors: DataFrame, now_ms: int) -> DataFrame:
    """Failed requests on their way to another try, or to failure.

    ``errors`` holds ``request_id``, ``error_type``, ``error_message`` and
    ``relationship`` as given by ``classify``. A request with tries left gets
    its count raised and its time stamped. Of several errors of a request one
    counts: a failure before a retry, then the least type and message.
    """
    retryable = (F.col("relationship") == RETRY).alias("_retry")
    errors = errors.groupBy("request_id").agg(
        F.min(F.struct(retryable, "error_type", "error_message", "relationship")).alias("_first")
    ).select("request_id", "_first.*")
    failed = requests.drop("error_type", "error_message").join(
        errors.select("request_id", "error_type", "error_message", "relationship"),
        "request_id", "inner",
    )
    count = F.coalesce(F.col("retry_count"), F.lit(0))
    retried = F.col("relationship") == RETRY
    spent = retried & (count >= F.col("max_retries"))
    again = retried & ~spent
    return failed.select(
        *[name for name in requests.columns
          if name not in ("retry_count", "retry_last_time_ms", "error_type", "error_message")],
        F.when(again, count + 1).otherwise(F.col("retry_count")).alias("retry_count"),
        F.when(again, F.lit(now_ms)).otherwise(F.col("retry_last_time_ms"))
        .cast("long").alias("retry_last_time_ms"),
        F.when(again, next_backoff()).alias("backoff_ms"),
        "error_type",
        F.when(spent, F.concat("error_message", F.lit(" - Max retries exceeded")))
        .otherwise(F.col("error_message")).alias("error_message"),
        F.when(spent, F.lit(FAILURE)).otherwise(F.col("relationship")).alias("relationship"),
    )


def route_requests(requests: DataFrame, now_ms: int) -> DataFrame:
    """Requests with the output they go to before any mail is read.

    A request that has to wait goes back to ``retry`` as it is, one that breaks
    a rule to ``failure``, any other one is handled and ends in ``original``.
    """
    checked = validate_requests(retry_ready(requests, now_ms))
    held = ~F.col("ready")
    invalid = F.col("error_type").isNotNull()
    return checked.withColumns({
        "relationship": F.when(held, F.lit(RETRY)).when(invalid, F.lit(FAILURE))
        .otherwise(F.lit(ORIGINAL)),
        "error_type": F.when(~held, F.col("error_type")),
        "error_message": F.when(~held, F.col("error_message")),
    }).drop("ready")


def resolve_folders(
    requests: DataFrame, folders: DataFrame, keep: list[str] | None = None, separator: str = "/"
) -> DataFrame:
    """Pairs (request, folder) of the folders each request selects.

    A plain request names its folder. A recursive one selects by path or, with
    a trailing ``*``, by prefix among the reachable folders within its depth.
    Both are equality joins: a folder is offered under each of its prefixes, and the
    requests look these up where they are read.
    ``keep`` names more request columns to carry along; the request's own target
    is carried as ``target`` if that is named.
    """
    carried = ["request_id", *(keep or [])]
    asked = requests.withColumn("target", F.col("folder"))
    plain = asked.filter(~F.col("recursive")).select(*carried, "folder")
    tree = reachable_folders(folders, separator).select("path")
    star = F.endswith(F.col("folder"), F.lit("*"))
    wanted = asked.filter(F.col("recursive")).select(
        *carried,
        F.when(F.col("max_recursion_depth") >= 0, F.col("max_recursion_depth"))
        .alias("_max_depth"),
        star.alias("_star"),
        F.when(star, F.expr("substring(folder, 1, length(folder) - 1)"))
        .otherwise(F.col("folder")).alias("_text"),
    )
    whole = tree.select("path", F.col("path").alias("_text"), F.lit(False).alias("_star"))
    prefixes = tree.select(
        "path",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.length("path")),
                lambda n: F.substring(F.col("path"), F.lit(1), n),
            )
        ).alias("_text"),
        F.lit(True).alias("_star"),
    )
    # The prefixes of the folders are looked up: many requests name the same few of them.
    found = lookup_join(
        wanted, whole.unionByName(prefixes), ["_text", "_star"], "inner", spread=["request_id"]
    ).filter(
        F.col("_max_depth").isNull()
        | (folder_depth(F.col("path"), separator) <= F.col("_max_depth"))
    )
    return plain.unionByName(found.select(*carried, F.col("path").alias("folder")))
