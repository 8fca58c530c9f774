"""The ingest job and attachments, over raw mails made from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailloom import FetchOptions
from mailloom.functions.attributes import attachment_attributes
from mailloom.operators import criteria as c
from mailloom.operators.attachments import attachments, explode_parts, with_parent
from mailloom.operators.project import project_headers
from mailloom.plans.fetch import fetch
from mailloom.schema import ATTACHMENTS_ONLY, HEADERS_ONLY
from mailloom.sources.ingest import errors, ingest
from suite import views
from suite.search import _tally, _tally_sql


def _spread(spark) -> int:
    """The given tables are single files; their mails are spread before parsing."""
    return 2 * spark.sparkContext.defaultParallelism


def _threads(spark, sf_dir):
    return ingest(views.threads_raw(spark, sf_dir), partitions=_spread(spark))


def _mixed(spark, sf_dir, with_content=True):
    return ingest(views.mixed_raw(spark, sf_dir), with_content, _spread(spark))


_TURNS = f"""{views.THREADS}, turns AS (
SELECT conv_id, uid, mail_id AS parent_message_id, CAST(place AS INTEGER) AS part_index,
       'turn-' || turn || '-' || role || '.txt' AS filename, 'text/plain' AS mime_type,
       octet_length(encode(text)) AS size, md5(text) AS content_md5
FROM threads WHERE place > 0)"""
_TURN_COLUMNS = "parent_message_id, part_index, filename, mime_type, size, content_md5"


def _shown(df, *more):
    return df.select(
        "parent_message_id", "part_index", "filename", "mime_type", "size",
        F.md5("content").alias("content_md5"), *more,
    )


def threads_messages(spark, sf_dir):
    return project_headers(_threads(spark, sf_dir), F.md5("content").alias("content_md5")).select(
        "folder", "uid", "subject", "sender", "to_addr", "cc_addr", "message_id", "size",
        "content_md5",
    )


_THREADS_MESSAGES = f"""WITH {views.THREADS}, bodies AS (
SELECT conv_id, uid, mail_id, string_agg(
  '--turnsep' || chr(10) || 'Content-Type: text/plain; charset=UTF-8' || chr(10)
  || 'Content-Transfer-Encoding: 8bit' || chr(10)
  || CASE WHEN place > 0 THEN 'Content-Disposition: attachment; filename="turn-' || turn || '-'
       || role || '.txt"' || chr(10) ELSE '' END
  || chr(10) || text || chr(10), '' ORDER BY turn) || '--turnsep--' || chr(10) AS body,
  'From: user' || conv_id || '@example.com' || chr(10) || 'To: desk@example.com' || chr(10)
  || 'Subject: Conversation ' || conv_id || chr(10)
  || 'Message-ID: ' || mail_id || chr(10)
  || 'MIME-Version: 1.0' || chr(10)
  || 'Content-Type: multipart/mixed; boundary="turnsep"' || chr(10) || chr(10) AS head
FROM threads GROUP BY conv_id, uid, mail_id)
SELECT 'Threads' AS folder, uid, 'Conversation ' || conv_id AS subject,
       'user' || conv_id || '@example.com' AS sender, 'desk@example.com' AS to_addr,
       '' AS cc_addr, mail_id AS message_id,
       octet_length(encode(head || body)) AS size, md5(body) AS content_md5
FROM bodies"""


def threads_attachments(spark, sf_dir):
    return _shown(attachments(_threads(spark, sf_dir)), "folder", "uid", "subject", "sender")


_THREADS_ATTACHMENTS = f"""WITH {_TURNS}
SELECT {_TURN_COLUMNS}, 'Threads' AS folder, uid,
       'Conversation ' || conv_id AS subject, 'user' || conv_id || '@example.com' AS sender
FROM turns"""


def attachments_capped(spark, sf_dir):
    return _shown(attachments(_threads(spark, sf_dir), max_count=3))


def attachments_sized(spark, sf_dir):
    """Too large parts are passed over and do not use up the count."""
    return _shown(attachments(_threads(spark, sf_dir), max_size=300, max_count=2))


_SIZED = f"""WITH {_TURNS}, ranked AS (
SELECT *, row_number() OVER (PARTITION BY uid ORDER BY part_index) AS r
FROM turns WHERE size <= 300)
SELECT {_TURN_COLUMNS} FROM ranked WHERE r <= 2"""


def attachments_only(spark, sf_dir):
    """The attachments mode: bare message rows, and the files with their attributes."""
    options = FetchOptions(folder="Threads", fetch_mode=ATTACHMENTS_ONLY,
                           include_attachments=True, batch_size=1000, max_attachments=2)
    run = fetch(_threads(spark, sf_dir), options, batch_id="a", capped=False)
    files = run.attachments.withColumn("attributes", attachment_attributes()).select(
        F.lit("attachments").alias("relationship"), "uid",
        F.col("attributes")["attachment.filename"].alias("filename"),
        F.col("attributes")["attachment.size"].alias("size"),
        F.col("attributes")["email.parent.message.id"].alias("message_id"),
        F.col("attributes")["email.batch.id"].alias("batch_id"),
    )
    rows = run.success.select(
        F.lit("success").alias("relationship"), "uid", F.lit("").alias("filename"),
        F.lit("").alias("size"), "message_id", "batch_id",
    )
    return rows.unionByName(files)


_ATTACHMENTS_ONLY = f"""WITH {_TURNS}
SELECT 'attachments' AS relationship, uid, filename,
       CASE WHEN size > 0 THEN CAST(size AS VARCHAR) ELSE 'unknown' END AS size,
       parent_message_id AS message_id, 'a' AS batch_id
FROM turns WHERE part_index <= 2
UNION ALL
SELECT DISTINCT 'success', uid, '', '', mail_id, 'a' FROM threads"""


def threads_parts(spark, sf_dir):
    parts = explode_parts(_threads(spark, sf_dir))
    return parts.groupBy("folder", "uid").agg(
        F.count(F.lit(1)).alias("n_parts"), F.max("walk_pos").alias("last_pos"),
        F.sum("size").alias("bytes"),
    )


_THREADS_PARTS = f"""WITH {views.THREADS}
SELECT 'Threads' AS folder, uid, count(*) AS n_parts, CAST(count(*) - 1 AS INTEGER) AS last_pos,
  CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes
FROM threads GROUP BY uid"""


def attachment_parent(spark, sf_dir):
    mails = _threads(spark, sf_dir)
    linked = with_parent(attachments(mails), mails, "subject", "size")
    return linked.select("filename", "uid", "parent_subject",
                         (F.col("parent_size") > F.col("size")).alias("fits"))


_PARENT = f"""WITH {_TURNS}
SELECT filename, uid, 'Conversation ' || conv_id AS parent_subject, true AS fits
FROM turns"""

# -- mails in many forms ------------------------------------------------------

_MIXED = """mixed AS (
SELECT doc_id, doc_id % 10 AS form, lang, 'Mixed/' || lang AS folder, doc_id + 1 AS uid,
       replace(text, chr(13), ' ') AS text FROM documents)"""


def mixed_headers(spark, sf_dir):
    """Encoded words, missing and unreadable headers."""
    rows = project_headers(_mixed(spark, sf_dir, with_content=False))
    return rows.select(
        "folder", "uid", "subject", "sender", "to_addr", "cc_addr",
        F.coalesce(F.unix_millis("sent_ts"), F.lit(-1)).alias("sent_ms"),
        "flags", "message_id", "in_reply_to",
    )


_MIXED_HEADERS = f"""WITH {_MIXED}
SELECT folder, uid,
  CASE form WHEN 1 THEN 'Re: é ' || doc_id WHEN 2 THEN 'é ' || doc_id || 'é ' || doc_id
    WHEN 9 THEN '=?x-none?B?eA==?= ' || doc_id ELSE 'Document ' || doc_id END AS subject,
  CASE form WHEN 7 THEN 'unknown'
    ELSE '"Desk, ' || lang || '" <desk-' || lang || '@example.com>' END AS sender,
  CASE WHEN form <> 8 THEN 'reader' || doc_id || '@example.com' END AS to_addr,
  CASE WHEN form <> 8 THEN '' END AS cc_addr,
  CASE WHEN form <> 8 THEN epoch_ms(TIMESTAMP '2024-01-16 12:30:00') ELSE -1 END AS sent_ms,
  CASE WHEN form <> 8 THEN '' END AS flags,
  CASE WHEN form <> 8 THEN '<mixed-' || doc_id || '@example.com>' END AS message_id,
  CASE WHEN form <> 8 THEN '<parent-' || doc_id || '@example.com>' END AS in_reply_to
FROM mixed"""


def mixed_search(spark, sf_dir):
    return _tally(_mixed(spark, sf_dir, with_content=False), {
        "header": c.header("IN-reply-to", "<PARENT-1"),
        "from": c.from_("desk-en"),
        "from_second": c.from_("other@"),
        "subject": c.subject("É 1"),
        "sent": c.senton("16-Jan-2024"),
        "to": c.to("reader2"),
    })


_MIXED_TALLY = {
    "header": "contains('<parent-' || doc_id, '<parent-1')",
    "from": "form <> 7 AND lang = 'en'",
    "from_second": "form <> 7",
    "subject": "form IN (1, 2) AND starts_with(CAST(doc_id AS VARCHAR), '1')",
    "sent": "true",
    "to": "form <> 8 AND starts_with(CAST(doc_id AS VARCHAR), '2')",
}


def mixed_bodies(spark, sf_dir):
    """Full messages: decoded bodies, and mails whose body cannot be decoded."""
    run = fetch(_mixed(spark, sf_dir), FetchOptions(folder="*", recursive=True), capped=False)
    return run.tagged().select(
        "relationship", "folder", "uid",
        F.when(~((F.col("uid") - 1) % 10).isin(5, 6), F.md5("content")).alias("content_md5"),
        F.col("attributes")["error.type"].alias("error_type"),
        F.col("attributes")["error.message"].alias("error_message"),
    )


_MIXED_BODIES = f"""WITH {_MIXED}
SELECT CASE WHEN form IN (3, 4) THEN 'parse-error' ELSE 'success' END AS relationship,
  folder, uid,
  CASE WHEN form IN (0, 1, 7, 8, 9) THEN md5(text)
       WHEN form = 2 THEN md5('café ' || doc_id || '!') END AS content_md5,
  CASE WHEN form IN (3, 4) THEN 'MESSAGE_PROCESSING_ERROR' END AS error_type,
  CASE form WHEN 3 THEN 'incomplete base64 data' WHEN 4 THEN 'Unknown encoding: x-rot13' END
    AS error_message
FROM mixed"""


def mixed_headers_only(spark, sf_dir):
    """A body that cannot be decoded does not matter when it is not wanted."""
    options = FetchOptions(folder="Mixed/*", recursive=True, fetch_mode=HEADERS_ONLY)
    run = fetch(_mixed(spark, sf_dir), options, all_of=[c.header("Message-ID", "mixed")],
                capped=False)
    return run.success.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n"), F.max("uid").alias("last_uid")
    )


def parse_errors(spark, sf_dir):
    return errors(_mixed(spark, sf_dir)).select("folder", "uid", "error_type", "error_message")


_PARSE_ERRORS = f"""WITH {_MIXED}
SELECT folder, uid, 'MESSAGE_PROCESSING_ERROR' AS error_type,
  CASE form WHEN 3 THEN 'incomplete base64 data' ELSE 'Unknown encoding: x-rot13' END
    AS error_message
FROM mixed WHERE form IN (3, 4)"""

#: Files of the mixed mails: place in the mail, and what is found there.
_MIXED_FILES = f"""{_MIXED}, files AS (
SELECT doc_id, folder, uid, 1 AS pos, '1' AS path, 1 AS part_index, 'one.bin' AS filename,
       'Application/X-Data' AS mime_type, length(to_base64(encode(text))) AS size,
       md5(text) AS content_md5 FROM mixed WHERE form = 5
UNION ALL
SELECT doc_id, folder, uid, 2, '2.0', 0, 'named.txt', 'text/plain',
       length(CAST(doc_id AS VARCHAR)), md5(CAST(doc_id AS VARCHAR)) FROM mixed WHERE form = 5
UNION ALL
SELECT doc_id, folder, uid, 3, '3', 3, 'attachment_3', 'message/rfc822',
       length('Subject: inner ' || doc_id) + 12,
       md5('Subject: inner ' || doc_id || chr(10) || chr(10) || 'inner body')
FROM mixed WHERE form = 5
UNION ALL
SELECT doc_id, folder, uid, 1, '1', 1, 'first.txt', 'Application/X-Data',
       length(CAST(doc_id AS VARCHAR)), md5(CAST(doc_id AS VARCHAR)) FROM mixed WHERE form = 6)"""


def _files(df):
    return df.select(
        "folder", "uid", F.array_join(F.col("part_path").cast("array<string>"), ".").alias("path"),
        "part_index", "filename", "mime_type", "size", F.md5("content").alias("content_md5"),
    )


def mixed_attachments(spark, sf_dir):
    """Nested parts, names, attached mails; an unreadable part ends the list."""
    return _files(attachments(_mixed(spark, sf_dir)))


def mixed_attachments_limited(spark, sf_dir):
    return _files(attachments(_mixed(spark, sf_dir), max_size=60, max_count=2))


_LIMITED = f"""WITH {_MIXED_FILES}, ranked AS (
SELECT *, row_number() OVER (PARTITION BY uid ORDER BY pos) AS r FROM files WHERE size <= 60)
SELECT folder, uid, path, part_index, filename, mime_type, size, content_md5
FROM ranked WHERE r <= 2"""


def mixed_parts(spark, sf_dir):
    """All leaves, attachments or not, of mails with several parts."""
    return explode_parts(_mixed(spark, sf_dir)).select(
        "folder", "uid", "walk_pos", "disposition", "filename", "fault"
    )


_MIXED_PARTS = f"""WITH {_MIXED}, leaves(form, walk_pos, disposition, filename, fault) AS (VALUES
  (5, 0, NULL, NULL, NULL), (5, 1, 'attachment', 'one.bin', NULL),
  (5, 2, NULL, 'named.txt', NULL), (5, 3, 'inline', 'shown.png', NULL),
  (5, 4, 'attachment', NULL, NULL),
  (6, 0, NULL, NULL, NULL), (6, 1, 'attachment', 'first.txt', NULL),
  (6, 2, 'attachment', 'bad.bin', 'incomplete base64 data'),
  (6, 3, 'attachment', 'last.txt', NULL))
SELECT folder, uid, walk_pos, disposition, filename, fault
FROM mixed JOIN leaves USING (form)"""


QUERIES = {
    "threads_messages": (threads_messages, _THREADS_MESSAGES),
    "threads_attachments": (threads_attachments, _THREADS_ATTACHMENTS),
    "threads_parts": (threads_parts, _THREADS_PARTS),
    "attachments_capped": (
        attachments_capped, f"WITH {_TURNS} SELECT {_TURN_COLUMNS} FROM turns WHERE part_index <= 3"
    ),
    "attachments_sized": (attachments_sized, _SIZED),
    "attachments_only": (attachments_only, _ATTACHMENTS_ONLY),
    "attachment_parent": (attachment_parent, _PARENT),
    "mixed_headers": (mixed_headers, _MIXED_HEADERS),
    "mixed_search": (mixed_search, _tally_sql(_MIXED, _MIXED_TALLY, "mixed")),
    "mixed_bodies": (mixed_bodies, _MIXED_BODIES),
    "mixed_headers_only": (
        mixed_headers_only,
        f"WITH {_MIXED} SELECT folder, count(*) AS n, max(uid) AS last_uid FROM mixed "
        "GROUP BY folder",
    ),
    "parse_errors": (parse_errors, _PARSE_ERRORS),
    "mixed_attachments": (
        mixed_attachments,
        f"WITH {_MIXED_FILES} SELECT folder, uid, path, part_index, filename, mime_type, size, "
        "content_md5 FROM files",
    ),
    "mixed_attachments_limited": (mixed_attachments_limited, _LIMITED),
    "mixed_parts": (mixed_parts, _MIXED_PARTS),
}
