"""Landed files, stored message tables and written routes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom import FetchOptions
from mailloom.operators.attachments import attachments
from mailloom.operators.cursor import after_cursor
from mailloom.operators.mailbox import resolve, with_marks
from mailloom.plans.fetch import fetch, split_oversize
from mailloom.sources.ingest import ingest, save_messages, write_messages
from mailloom.sources.landing import read_envelopes, read_messages, read_raw, stream_raw
from mailloom.sources.sinks import read_route, write_routes
from suite import views
from suite.mime import _MIXED, _spread
from suite.scratch import scratch


#: Files of a micro-batch.
FILES_A_BATCH = 100_000


def land(raw: DataFrame, root: str) -> None:
    """Put raw mails below ``root`` as ``<folder>/<uid>.eml``, from the tasks that hold them."""
    uri = root.replace("file:/", "file:///", 1) if root.startswith("file:/") else root

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(uri)
        made: set[str] = set()
        for batch in batches:
            for row in batch.to_pylist():
                folder = f"{base}/{row['folder']}"
                if folder not in made:
                    files.create_dir(folder)
                    made.add(folder)
                with files.open_output_stream(f"{folder}/{row['uid']}.eml") as out:
                    out.write(row["raw"])
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    landed = raw.select("folder", "uid", "raw").mapInArrow(put, "n long")
    landed.write.format("noop").mode("overwrite").save()


def landed_files(spark, sf_dir):
    """Mail files: folder and UID from the path, size from the listing, then attachments."""
    root = scratch(spark)
    land(views.mixed_raw(spark, sf_dir), root)
    raw = read_raw(spark, root)
    files = attachments(ingest(raw)).groupBy("folder", "uid").agg(
        F.count(F.lit(1)).alias("files")
    )
    return raw.select("folder", "uid", (F.col("size") > 0).alias("sized")).join(
        files, ["folder", "uid"], "left"
    ).withColumn("files", F.coalesce("files", F.lit(0)))


_LANDED_FILES = f"""WITH {_MIXED}
SELECT folder, uid, true AS sized,
       CASE form WHEN 5 THEN 3 WHEN 6 THEN 1 ELSE 0 END AS files FROM mixed"""


def landed_oversize(spark, sf_dir):
    """Oversize mails are reported from the listing, without opening a file."""
    root = scratch(spark)
    raw = views.threads_raw(spark, sf_dir)
    land(raw, root)
    _, errors = split_oversize(read_raw(spark, root), 3000)
    return errors.select("folder", "uid", "error_type")


_LANDED_OVERSIZE = f"""WITH {views.THREADS}, mails AS (
SELECT uid, mail_id, conv_id, sum(octet_length(encode(
    '--turnsep' || chr(10) || 'Content-Type: text/plain; charset=UTF-8' || chr(10)
    || 'Content-Transfer-Encoding: 8bit' || chr(10)
    || CASE WHEN place > 0 THEN 'Content-Disposition: attachment; filename="turn-' || turn
         || '-' || role || '.txt"' || chr(10) ELSE '' END
    || chr(10) || text || chr(10)))) AS size
FROM threads GROUP BY ALL)
SELECT 'Threads' AS folder, uid, 'MESSAGE_TOO_LARGE' AS error_type FROM mails
WHERE size + octet_length(encode('--turnsep--' || chr(10)))
  + octet_length(encode('From: user' || conv_id || '@example.com' || chr(10)
      || 'To: desk@example.com' || chr(10) || 'Subject: Conversation ' || conv_id || chr(10)
      || 'Message-ID: ' || mail_id || chr(10) || 'MIME-Version: 1.0' || chr(10)
      || 'Content-Type: multipart/mixed; boundary="turnsep"' || chr(10) || chr(10))) > 3000"""


def landed_stream(spark, sf_dir):
    """Files that land in two waves, ingested by a stream that is started twice."""
    base = scratch(spark)
    mails = views.mixed_raw(spark, sf_dir)
    for wave in (0, 1):
        land(mails.filter(F.col("uid") % 2 == wave), f"{base}/in")
        (
            ingest(
                stream_raw(spark, f"{base}/in", max_files=FILES_A_BATCH, log=f"{base}/log")
            ).writeStream.format("parquet")
            .option("path", f"{base}/messages").option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).start().awaitTermination()
        )
    return read_messages(spark, f"{base}/messages").select("folder", "uid", "message_id")


_LANDED_STREAM = f"""WITH {_MIXED}
SELECT folder, uid, '<mixed-' || doc_id || '@example.com>' AS message_id FROM mixed"""


def _stored(spark, sf_dir) -> str:
    path = f"{scratch(spark)}/messages"
    write_messages(ingest(views.mixed_raw(spark, sf_dir), partitions=_spread(spark)), path)
    return path


def stored_envelopes(spark, sf_dir):
    """New envelopes above half of each folder's highest UID, read without any body."""
    envelopes = read_envelopes(spark, _stored(spark, sf_dir))
    half = envelopes.groupBy("folder").agg(F.floor(F.max("uid") / 2).alias("last_uid"))
    new = after_cursor(envelopes, half)
    return new.select("folder", "uid", "subject")


_STORED_ENVELOPES = f"""WITH {_MIXED}
SELECT folder, uid,
  CASE form WHEN 1 THEN 'Re: é ' || doc_id WHEN 2 THEN 'é ' || doc_id || 'é ' || doc_id
    WHEN 9 THEN '=?x-none?B?eA==?= ' || doc_id ELSE 'Document ' || doc_id END AS subject
FROM mixed JOIN (SELECT folder AS f, max(uid) // 2 AS last_uid FROM mixed GROUP BY 1) ON f = folder
WHERE uid > last_uid"""


def stored_routes(spark, sf_dir):
    """A run written to one folder per output, and read back output by output."""
    mails = read_messages(spark, _stored(spark, sf_dir))
    options = FetchOptions(folder="Mixed/*", recursive=True, include_attachments=True,
                           batch_size=5, max_attachments=2)
    path = f"{scratch(spark)}/routes"
    write_routes(fetch(mails, options, batch_id="b").tagged(), path)
    parts = [
        read_route(spark, path, name).select(
            "relationship", "folder", "uid",
            F.coalesce(F.col("attributes")["attachment.filename"], F.lit("")).alias("filename"),
        )
        for name in ("success", "attachments", "parse-error")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_STORED_ROUTES = f"""WITH {_MIXED}, counted AS (
SELECT *, form NOT IN (3, 4) AS ok,
  coalesce(sum(CASE WHEN form NOT IN (3, 4) THEN 1 ELSE 0 END) OVER (
    PARTITION BY folder ORDER BY uid
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM mixed),
reached AS (SELECT * FROM counted WHERE before < 50),
files(form, filename) AS (VALUES (5, 'one.bin'), (5, 'named.txt'), (6, 'first.txt'))
SELECT CASE WHEN ok THEN 'success' ELSE 'parse-error' END AS relationship, folder, uid,
       '' AS filename FROM reached
UNION ALL
SELECT 'attachments', folder, uid, filename FROM reached JOIN files USING (form)"""


def _saved(spark, sf_dir) -> DataFrame:
    """The whole mailbox as a table bucketed by folder and UID."""
    path = scratch(spark)
    mails = views.messages(spark, sf_dir)
    return save_messages(mails, path.rsplit("/", 1)[1].replace("-", "_"), 8, f"{path}/saved")


def saved_resolved(spark, sf_dir):
    """Content by UIDs, some of which no longer exist, looked up where the content lies."""
    mails = _saved(spark, sf_dir)
    ids = mails.select("folder", (F.col("uid") * 2).alias("uid"))
    return resolve(ids, mails, max_bytes=0).select(
        "folder", "uid", F.sha2("content", 256).alias("content_sha256")
    )


_SAVED_RESOLVED = f"""WITH {views.MESSAGES}
SELECT m.folder, m.uid, sha256(m.text) AS content_sha256 FROM messages m
WHERE (m.folder, m.uid) IN (SELECT folder, uid * 2 FROM messages)"""


def saved_marks(spark, sf_dir):
    """Marks of every third message, merged where the content lies, and an expunge."""
    mails = _saved(spark, sf_dir)
    marks = mails.filter("uid % 3 = 0").select(
        "folder", "uid", (F.col("uid") % 2 == 0).alias("read"),
        ((F.col("uid") % 5 == 0) & (F.col("size") > 200)).alias("deleted"),
    )
    return with_marks(mails, marks, max_bytes=0).select(
        "folder", "uid", F.array_contains("flags", "SEEN").alias("read"),
        F.sha2("content", 256).alias("content_sha256"),
    )


_SAVED_MARKS = f"""WITH {views.MESSAGES}, marked AS (
SELECT *, uid % 3 = 0 AND uid % 5 = 0 AND size > 200 AS gone FROM messages)
SELECT folder, uid, seen OR uid % 6 = 0 AS read, sha256(text) AS content_sha256
FROM marked
WHERE NOT gone AND NOT (deleted AND folder IN (SELECT folder FROM marked WHERE gone))"""


QUERIES = {
    "saved_resolved": (saved_resolved, _SAVED_RESOLVED),
    "saved_marks": (saved_marks, _SAVED_MARKS),
    "landed_files": (landed_files, _LANDED_FILES),
    "landed_oversize": (landed_oversize, _LANDED_OVERSIZE),
    "landed_stream": (landed_stream, _LANDED_STREAM),
    "stored_envelopes": (stored_envelopes, _STORED_ENVELOPES),
    "stored_routes": (stored_routes, _STORED_ROUTES),
}
