"""Fetch requests: defaults, checks, retries, folders and the fetch itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailloom.functions.units import data_size_bytes
from mailloom.operators import criteria as c
from mailloom.operators.folders import folder_table
from mailloom.operators.joins import materialise
from mailloom.operators.requests import (
    classify,
    next_backoff,
    resolve_folders,
    retry_ready,
    retry_route,
    retry_wait_ms,
    route_requests,
    validate_requests,
    with_defaults,
)
from mailloom.plans.requests import (
    fetch_for_requests,
    run_request_step,
    run_requests,
    settle_requests,
)
from suite import views
from suite.scratch import scratch
from suite.views import CURSORS, MESSAGES, NOW_MS, REQUESTS

_OPTIONS = [
    "request_id", "folder", "recursive", "max_recursion_depth", "state_folder", "batch_size",
    "fetch_mode", "include_headers", "include_attachments", "incremental", "max_message_size",
    "max_attachment_size", "max_attachments", "max_retries", "retry_backoff_ms",
]


def _requests(spark, sf_dir):
    return with_defaults(views.requests(spark, sf_dir))


def _folders(spark, sf_dir):
    return materialise(folder_table(views.messages(spark, sf_dir)))


def _counted(name):
    """A number of a request, -1 where there is none."""
    return F.coalesce(F.col(name), F.lit(-1)).alias(name)


def request_defaults(spark, sf_dir):
    return _requests(spark, sf_dir).select(*_OPTIONS)


_CHECKED = f"""{REQUESTS}, checked AS (
SELECT *,
  coalesce(retry_last_time_ms > {NOW_MS} - retry_backoff_ms
    * CASE WHEN retry_count = 0 THEN 0 ELSE CAST(pow(2, retry_count - 1) AS BIGINT) END, false)
    AS held,
  CASE WHEN trim(folder) = '' THEN 'INVALID_FOLDER'
    WHEN batch_size <= 0 THEN 'INVALID_BATCH_SIZE'
    WHEN max_message_size <= 0 THEN 'INVALID_MAX_MESSAGE_SIZE'
    WHEN include_attachments AND max_attachment_size <= 0 THEN 'INVALID_MAX_ATTACHMENT_SIZE'
    WHEN include_attachments AND max_attachment_size > max_message_size THEN 'INVALID_SIZE_LIMITS'
    WHEN include_attachments AND max_attachments <= 0 THEN 'INVALID_MAX_ATTACHMENTS'
    WHEN max_retries < 0 THEN 'INVALID_MAX_RETRIES'
    WHEN retry_backoff_ms <= 0 THEN 'INVALID_RETRY_BACKOFF'
    WHEN fetch_mode = 'ATTACHMENTS_ONLY' AND NOT include_attachments THEN 'INVALID_FETCH_MODE'
    WHEN max_recursion_depth < -1 OR max_recursion_depth = 0 THEN 'INVALID_MAX_RECURSION_DEPTH'
  END AS error_type
FROM requests), tree AS (
SELECT DISTINCT folder AS path, 3 AS depth FROM messages
UNION ALL SELECT DISTINCT regexp_replace(folder, '/[^/]*$', ''), 2 FROM messages
UNION ALL SELECT 'Archive', 1 UNION ALL SELECT '', 0),
targets AS (
SELECT request_id, folder FROM requests WHERE NOT recursive
UNION ALL
SELECT request_id, path FROM requests JOIN tree
  ON recursive AND (max_recursion_depth < 0 OR depth <= max_recursion_depth)
  AND (path = folder OR (ends_with(folder, '*') AND starts_with(path, rtrim(folder, '*')))))"""


def retry_gate(spark, sf_dir):
    gated = retry_ready(_requests(spark, sf_dir), NOW_MS)
    return gated.select(
        "request_id", "ready", F.coalesce(retry_wait_ms(), F.lit(-1)).alias("wait_ms"),
        next_backoff().alias("next_ms"),
    )


_RETRY_GATE = f"""WITH {MESSAGES}, {_CHECKED}
SELECT request_id, NOT held AS ready,
  CAST(coalesce(retry_backoff_ms * CASE WHEN retry_count = 0 THEN 0
    ELSE CAST(pow(2, retry_count - 1) AS BIGINT) END, -1) AS BIGINT) AS wait_ms,
  CAST(retry_backoff_ms * CAST(pow(2, coalesce(retry_count, 0)) AS BIGINT) AS BIGINT) AS next_ms
FROM checked"""


def retry_overflow(spark, sf_dir):
    """Waits of requests that were retried up to 200 times, and sizes of any length."""
    asked = views.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS request_id", "10000L AS retry_backoff_ms",
        "CAST(c_custkey % 201 AS INT) AS retry_count",
        "concat(repeat('9', CAST(c_custkey % 25 + 1 AS INT)), ' TB') AS text",
    )
    return asked.select(
        "request_id", next_backoff().alias("next_ms"),
        data_size_bytes(F.col("text"), 7).alias("bytes"),
    )


_RETRY_OVERFLOW = """SELECT c_custkey AS request_id,
  CASE WHEN c_custkey % 201 >= 50 THEN 9223372036854775807
       ELSE 10000 * CAST(pow(2, c_custkey % 201) AS BIGINT) END AS next_ms,
  CASE WHEN c_custkey % 25 + 1 > 6 THEN 7
       ELSE CAST(repeat('9', CAST(c_custkey % 25 + 1 AS INTEGER)) AS BIGINT) * 1099511627776 END
    AS bytes
FROM customer"""


def double_faults(spark, sf_dir):
    """Requests with two faults each have one row: a failure counts before a retry."""
    asked = views.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS request_id", "3 AS max_retries", "1000L AS retry_backoff_ms",
        "CAST(c_custkey % 5 AS INT) AS retry_count", "0L AS retry_last_time_ms",
    )
    faults = asked.selectExpr("request_id", "'messaging' AS kind", "'lost' AS message").unionByName(
        asked.selectExpr(
            "request_id", "if(request_id % 2 = 1, 'other', 'messaging') AS kind",
            "'broken' AS message",
        )
    )
    return retry_route(asked, classify(faults), NOW_MS).select(
        "request_id", "relationship", "error_type", "error_message", "retry_count"
    )


_DOUBLE_FAULTS = """SELECT c_custkey AS request_id,
  CASE WHEN c_custkey % 2 = 1 OR c_custkey % 5 >= 3 THEN 'failure' ELSE 'retry' END AS relationship,
  CASE WHEN c_custkey % 2 = 1 THEN 'UNEXPECTED_ERROR' ELSE 'CONNECTION_ERROR' END AS error_type,
  CASE WHEN c_custkey % 2 = 0 AND c_custkey % 5 >= 3 THEN 'broken - Max retries exceeded'
       ELSE 'broken' END AS error_message,
  CAST(c_custkey % 5 + CASE WHEN c_custkey % 2 = 0 AND c_custkey % 5 < 3 THEN 1 ELSE 0 END
       AS INTEGER) AS retry_count
FROM customer"""


def request_checks(spark, sf_dir):
    checked = validate_requests(_requests(spark, sf_dir))
    return checked.select("request_id", "error_type", "error_message")


_CHECKS = f"""WITH {MESSAGES}, {_CHECKED}
SELECT request_id, error_type, CASE error_type
  WHEN 'INVALID_FOLDER' THEN 'folder cannot be empty'
  WHEN 'INVALID_BATCH_SIZE' THEN 'batch size must be positive'
  WHEN 'INVALID_MAX_MESSAGE_SIZE' THEN 'Max message size must be positive'
  WHEN 'INVALID_MAX_ATTACHMENT_SIZE' THEN 'Max attachment size must be positive'
  WHEN 'INVALID_SIZE_LIMITS' THEN 'Max attachment size cannot exceed max message size'
  WHEN 'INVALID_MAX_ATTACHMENTS' THEN 'Max attachments per message must be positive'
  WHEN 'INVALID_MAX_RETRIES' THEN 'Max retries must be non-negative'
  WHEN 'INVALID_RETRY_BACKOFF' THEN 'Retry backoff must be positive'
  WHEN 'INVALID_FETCH_MODE' THEN
    'attachments alone cannot be fetched while attachments are left out'
  WHEN 'INVALID_MAX_RECURSION_DEPTH' THEN
    'recursion depth has to be positive, or -1 for any depth' END AS error_message
FROM checked"""


def request_routes(spark, sf_dir):
    routed = route_requests(_requests(spark, sf_dir), NOW_MS)
    return routed.select("request_id", "relationship", "error_type", _counted("retry_count"))


_ROUTES = f"""WITH {MESSAGES}, {_CHECKED}
SELECT request_id, CASE WHEN held THEN 'retry' WHEN error_type IS NOT NULL THEN 'failure'
       ELSE 'original' END AS relationship,
       CASE WHEN NOT held THEN error_type END AS error_type,
       coalesce(retry_count, -1) AS retry_count FROM checked"""


def _faults(requests):
    """A problem for each of the requests, of one kind or another."""
    key = F.col("request_id")
    return requests.select(
        "request_id",
        F.when(key % 5 == 0, F.lit("messaging")).when(key % 5 == 1, F.lit("io")).alias("kind"),
        F.concat(F.lit("fault "), key.cast("string")).alias("message"),
    )


def fault_classes(spark, sf_dir):
    return classify(_faults(_requests(spark, sf_dir))).select(
        "request_id", "error_type", "error_message", "relationship"
    )


_FAULT_CLASSES = f"""WITH {REQUESTS}
SELECT request_id,
  CASE request_id % 5 WHEN 0 THEN 'CONNECTION_ERROR' ELSE 'UNEXPECTED_ERROR' END AS error_type,
  'fault ' || request_id AS error_message,
  CASE request_id % 5 WHEN 0 THEN 'retry' ELSE 'failure' END AS relationship
FROM requests"""


def retry_routes(spark, sf_dir):
    requests = _requests(spark, sf_dir)
    failed = retry_route(requests, classify(_faults(requests)), NOW_MS)
    return failed.select(
        "request_id", "relationship", _counted("retry_count"), _counted("retry_last_time_ms"),
        _counted("backoff_ms"), "error_type", "error_message",
    )


_RETRY_ROUTES = f"""WITH {REQUESTS}, failed AS (
SELECT *, request_id % 5 = 0 AS mail,
  request_id % 5 = 0 AND coalesce(retry_count, 0) < max_retries AS again
FROM requests)
SELECT request_id, CASE WHEN again THEN 'retry' ELSE 'failure' END AS relationship,
  coalesce(CASE WHEN again THEN coalesce(retry_count, 0) + 1 ELSE retry_count END, -1)
    AS retry_count,
  coalesce(CASE WHEN again THEN {NOW_MS} ELSE retry_last_time_ms END, -1) AS retry_last_time_ms,
  CASE WHEN again THEN CAST(retry_backoff_ms * CAST(pow(2, coalesce(retry_count, 0)) AS BIGINT)
    AS BIGINT) ELSE -1 END AS backoff_ms,
  CASE WHEN mail THEN 'CONNECTION_ERROR' ELSE 'UNEXPECTED_ERROR' END AS error_type,
  'fault ' || request_id || CASE WHEN mail AND NOT again THEN ' - Max retries exceeded' ELSE '' END
    AS error_message
FROM failed"""


def request_folders(spark, sf_dir):
    return resolve_folders(_requests(spark, sf_dir), _folders(spark, sf_dir))


def _searches():
    return {"flagged": c.flagged(), "large": c.larger(2000)}


def _searching(requests):
    """Some requests choose a named search."""
    key = F.col("request_id")
    return requests.withColumn(
        "search", F.when(key % 10 == 4, F.lit("flagged")).when(key % 10 == 5, F.lit("large"))
    )


def _valid(spark, sf_dir):
    checked = validate_requests(_requests(spark, sf_dir))
    return _searching(checked.filter(F.col("error_type").isNull()))


def _handled(spark, sf_dir):
    return fetch_for_requests(
        _valid(spark, sf_dir), _folders(spark, sf_dir), views.messages(spark, sf_dir),
        views.cursors(spark, sf_dir), _searches(), batch_id="b",
    )


def request_fetch(spark, sf_dir):
    """What each request delivers of each of its folders."""
    handled = _handled(spark, sf_dir)
    rows = handled.success.select(
        "request_id", "folder", "uid", F.lit("success").alias("relationship"),
        "subject", F.md5("content").alias("content_md5"),
    )
    none = F.lit(None).cast("string")
    errors = handled.parse_error.select(
        "request_id", "folder", "uid", F.lit("parse-error").alias("relationship"),
        none.alias("subject"), none.alias("content_md5"),
    )
    return rows.unionByName(errors)


_FOUND = f"""{MESSAGES}, {CURSORS}, {_CHECKED}, found AS (
SELECT r.request_id, m.folder, m.uid, m.size, m.subject, m.text, r.batch_size, r.fetch_mode,
       r.include_headers, r.state_folder, r.incremental, m.size <= r.max_message_size AS ok
FROM checked r JOIN targets t ON r.request_id = t.request_id
JOIN messages m ON m.folder = t.folder
LEFT JOIN cursors c ON r.incremental AND c.state_folder = r.state_folder AND c.folder = m.folder
WHERE r.error_type IS NULL AND (c.last_uid IS NULL OR m.uid > c.last_uid)
  AND (r.request_id % 10 <> 4 OR m.flagged) AND (r.request_id % 10 <> 5 OR m.size > 2000)),
counted AS (
SELECT *, coalesce(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (
  PARTITION BY request_id, folder ORDER BY uid
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM found)"""

_REQUEST_FETCH = f"""WITH {_FOUND}
SELECT request_id, folder, uid, CASE WHEN ok THEN 'success' ELSE 'parse-error' END AS relationship,
  CASE WHEN ok AND include_headers THEN subject END AS subject,
  CASE WHEN ok AND fetch_mode = 'FULL_MESSAGE' THEN md5(text) END AS content_md5
FROM counted WHERE before < 10 * batch_size"""


def request_many(spark, sf_dir):
    """Requests of all customers to one folder, with forty size limits and three caps."""
    asked = with_defaults(views.requests(spark, sf_dir).withColumns({
        "folder": F.lit("Archive/src1/en"), "recursive": F.lit(False),
        "max_recursion_depth": F.lit(-1), "fetch_mode": F.lit("FULL_MESSAGE"),
        "batch_size": (1 + F.col("request_id") % 3).cast("int"),
        "max_message_size": 500 + F.col("request_id") % 40 * 250,
        "incremental": F.lit(False), "include_attachments": F.lit(False),
    }))
    handled = fetch_for_requests(asked, _folders(spark, sf_dir), views.messages(spark, sf_dir))
    return handled.success.select(
        "request_id", "uid", F.md5("content").alias("content_md5")
    ).unionByName(handled.parse_error.select(
        "request_id", "uid", F.lit(None).cast("string").alias("content_md5")
    ))


_REQUEST_MANY = f"""WITH {MESSAGES}, found AS (
SELECT c_custkey AS request_id, uid, text, 1 + c_custkey % 3 AS batch_size,
       size <= 500 + c_custkey % 40 * 250 AS ok
FROM customer, messages WHERE folder = 'Archive/src1/en'),
counted AS (
SELECT *, coalesce(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (
  PARTITION BY request_id ORDER BY uid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  AS before FROM found)
SELECT request_id, uid, CASE WHEN ok THEN md5(text) END AS content_md5
FROM counted WHERE before < 10 * batch_size"""


def request_counts(spark, sf_dir):
    return _handled(spark, sf_dir).processed


def request_cursors(spark, sf_dir):
    return _handled(spark, sf_dir).cursors


_REQUEST_CURSORS = f"""WITH {_FOUND}
SELECT state_folder, folder, max(uid) AS last_uid FROM counted
WHERE ok AND incremental AND before < 10 * batch_size GROUP BY ALL"""


def request_settled(spark, sf_dir):
    """Where every request ends up: waiting, refused, failed or handled.

    The requests of customers in debt meet a problem.
    """
    requests = _requests(spark, sf_dir)
    in_debt = views.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0)
    ready = route_requests(requests, NOW_MS).filter(F.col("relationship") == "original")
    faults = _faults(ready.join(
        in_debt.select(F.col("c_custkey").alias("request_id")), "request_id", "left_semi"
    ))
    settled = settle_requests(requests, _folders(spark, sf_dir), NOW_MS, faults)
    return settled.select(
        "request_id", "relationship", _counted("retry_count"), _counted("retry_last_time_ms"),
        "error_type",
    )


_REQUEST_SETTLED = f"""WITH {MESSAGES}, {_CHECKED}, staged AS (
SELECT *, NOT held AND error_type IS NULL AS ready FROM checked),
judged AS (
SELECT *,
  ready AND request_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AS faulty,
  ready AND NOT recursive AND folder = 'Missing' AS missing FROM staged),
failing AS (
SELECT *, (missing AND NOT faulty) OR (faulty AND request_id % 5 = 0) AS mail,
  CASE WHEN faulty THEN 'fault ' || request_id WHEN missing THEN 'Missing not found' END AS text
FROM judged),
ended AS (
SELECT *, mail AND coalesce(retry_count, 0) < max_retries AS again FROM failing)
SELECT request_id,
  CASE WHEN held THEN 'retry' WHEN error_type IS NOT NULL THEN 'failure'
    WHEN again THEN 'retry' WHEN text IS NOT NULL THEN 'failure' ELSE 'original' END
    AS relationship,
  coalesce(CASE WHEN again THEN coalesce(retry_count, 0) + 1 ELSE retry_count END, -1)
    AS retry_count,
  coalesce(CASE WHEN again THEN {NOW_MS} ELSE retry_last_time_ms END, -1) AS retry_last_time_ms,
  CASE WHEN held THEN NULL WHEN error_type IS NOT NULL THEN error_type
    WHEN mail THEN 'CONNECTION_ERROR' WHEN text IS NOT NULL THEN 'UNEXPECTED_ERROR' END
    AS error_type
FROM ended"""


def request_run(spark, sf_dir):
    """Mails delivered to the requests that are ready."""
    handled = run_requests(
        _requests(spark, sf_dir), _folders(spark, sf_dir),
        views.messages(spark, sf_dir), NOW_MS, views.cursors(spark, sf_dir),
    )
    return handled.success.select(
        "request_id", "folder", "uid", "message_id", F.md5("content").alias("content_md5")
    )


def request_step(spark, sf_dir):
    """A run over requests on disk: its six outputs, read back with their attributes.

    It is run twice; the second run replaces the first.
    """
    base = scratch(spark)
    for _ in range(2):
        run_request_step(
            _requests(spark, sf_dir), _folders(spark, sf_dir), views.messages(spark, sf_dir),
            0, f"{base}/out", f"{base}/state", NOW_MS,
        )
    rows = spark.read.parquet(f"{base}/out")
    return rows.select(
        "relationship", "request_id", "folder", "uid",
        F.coalesce(F.col("attributes")["error.type"], F.lit("")).alias("error_type"),
        F.coalesce(F.col("attributes")["retry.count"], F.lit("")).alias("retry_count"),
        F.coalesce(F.col("attributes")["email.message.id"], F.lit("")).alias("message_id"),
        F.coalesce(F.md5("content"), F.lit("")).alias("content_md5"),
    )


_REQUEST_STEP = f"""WITH {MESSAGES}, {_CHECKED}, found AS (
SELECT r.request_id, m.folder, m.uid, m.message_id, m.text, r.batch_size, r.include_headers,
       r.fetch_mode, m.size <= r.max_message_size AS ok
FROM checked r JOIN targets t ON r.request_id = t.request_id
JOIN messages m ON m.folder = t.folder WHERE r.error_type IS NULL AND NOT held),
counted AS (
SELECT *, coalesce(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (
  PARTITION BY request_id, folder ORDER BY uid
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM found),
judged AS (
SELECT *, NOT held AND error_type IS NULL AND NOT recursive AND folder = 'Missing' AS missing,
       coalesce(retry_count, 0) < max_retries AS again FROM checked)
SELECT CASE WHEN ok THEN 'success' ELSE 'parse-error' END AS relationship, request_id, folder, uid,
  CASE WHEN ok THEN '' ELSE 'MESSAGE_TOO_LARGE' END AS error_type, '' AS retry_count,
  CASE WHEN ok AND include_headers THEN message_id ELSE '' END AS message_id,
  CASE WHEN ok AND fetch_mode = 'FULL_MESSAGE' THEN md5(text) ELSE '' END AS content_md5
FROM counted WHERE before < 10 * batch_size
UNION ALL SELECT
  CASE WHEN held OR (missing AND again) THEN 'retry'
    WHEN error_type IS NOT NULL OR missing THEN 'failure' ELSE 'original' END,
  request_id, folder, NULL,
  CASE WHEN held THEN '' WHEN missing THEN 'CONNECTION_ERROR' ELSE coalesce(error_type, '') END,
  coalesce(CAST(CASE WHEN missing AND again THEN coalesce(retry_count, 0) + 1 ELSE retry_count END
    AS VARCHAR), ''), '', ''
FROM judged"""


_REQUEST_RUN = f"""WITH {MESSAGES}, {CURSORS}, {_CHECKED}, found AS (
SELECT r.request_id, m.folder, m.uid, m.message_id, m.text, r.batch_size, r.include_headers,
       r.fetch_mode, m.size <= r.max_message_size AS ok
FROM checked r JOIN targets t ON r.request_id = t.request_id
JOIN messages m ON m.folder = t.folder
LEFT JOIN cursors c ON r.incremental AND c.state_folder = r.state_folder AND c.folder = m.folder
WHERE r.error_type IS NULL AND NOT held AND (c.last_uid IS NULL OR m.uid > c.last_uid)),
counted AS (
SELECT *, coalesce(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (
  PARTITION BY request_id, folder ORDER BY uid
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM found)
SELECT request_id, folder, uid, CASE WHEN include_headers THEN message_id END AS message_id,
  CASE WHEN fetch_mode = 'FULL_MESSAGE' THEN md5(text) END AS content_md5
FROM counted WHERE ok AND before < 10 * batch_size"""


QUERIES = {
    "request_defaults": (
        request_defaults, f"WITH {REQUESTS} SELECT {', '.join(_OPTIONS)} FROM requests"
    ),
    "request_many": (request_many, _REQUEST_MANY),
    "retry_gate": (retry_gate, _RETRY_GATE),
    "retry_overflow": (retry_overflow, _RETRY_OVERFLOW),
    "double_faults": (double_faults, _DOUBLE_FAULTS),
    "request_checks": (request_checks, _CHECKS),
    "request_routes": (request_routes, _ROUTES),
    "fault_classes": (fault_classes, _FAULT_CLASSES),
    "retry_routes": (retry_routes, _RETRY_ROUTES),
    "request_folders": (
        request_folders, f"WITH {MESSAGES}, {_CHECKED} SELECT request_id, folder FROM targets"
    ),
    "request_fetch": (request_fetch, _REQUEST_FETCH),
    "request_counts": (
        request_counts,
        f"WITH {_FOUND} SELECT request_id, folder, count(*) AS processed FROM found GROUP BY ALL",
    ),
    "request_cursors": (request_cursors, _REQUEST_CURSORS),
    "request_settled": (request_settled, _REQUEST_SETTLED),
    "request_run": (request_run, _REQUEST_RUN),
    "request_step": (request_step, _REQUEST_STEP),
}
