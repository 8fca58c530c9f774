"""Mailbox views over the given tables, for Spark and as SQL text.

The SQL texts are common table expressions for the comparison queries. They
keep one plain column per flag and address where the Spark views have arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailloom.schema import SYSTEM_FLAGS

# Flags of a message, by document id.
_FLAGS = """array_compact(array(
  CASE WHEN doc_id % 2 = 0 THEN 'SEEN' END, CASE WHEN doc_id % 5 = 0 THEN 'FLAGGED' END,
  CASE WHEN doc_id % 7 = 0 THEN 'ANSWERED' END, CASE WHEN doc_id % 11 = 0 THEN 'DRAFT' END,
  CASE WHEN doc_id % 13 = 0 THEN 'DELETED' END, CASE WHEN doc_id % 3 = 0 THEN 'RECENT' END,
  CASE WHEN doc_id % 19 = 0 THEN 'Work' END))"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per document; its whole text is both subject and content."""
    received = "TIMESTAMP '2024-01-01 00:00:00' + make_dt_interval(0, CAST(doc_id AS INT))"
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('Archive/', source, '/', lang) AS folder",
        "doc_id + 1 AS uid",
        "concat('<doc-', doc_id, '@', source, '.example.com>') AS message_id",
        "text AS subject",
        "array(concat(source, '@', lang, '.example.com')) AS from_all",
        "array(concat('reader', doc_id % 17, '@example.com')) AS to_all",
        "if(doc_id % 4 = 0, array(concat('cc', doc_id % 9, '@example.com')), "
        "CAST(array() AS ARRAY<STRING>)) AS cc_all",
        "if(doc_id % 6 = 0, array(concat('bcc', doc_id % 8, '@example.com')), "
        "CAST(array() AS ARRAY<STRING>)) AS bcc_all",
        "array(struct('X-Lang' AS name, concat('lang-', lang) AS value)) AS headers",
        f"{_FLAGS} AS flags",
        "n_chars AS size",
        f"{received} AS received_ts",
        f"CASE WHEN doc_id % 10 <> 9 THEN {received} - INTERVAL 90 MINUTES END AS sent_ts",
        "encode(text, 'UTF-8') AS content",
    )


MESSAGES = """messages AS (
SELECT 'Archive/' || source || '/' || lang AS folder,
       CAST(doc_id + 1 AS BIGINT) AS uid,
       doc_id,
       '<doc-' || doc_id || '@' || source || '.example.com>' AS message_id,
       source || '@' || lang || '.example.com' AS sender,
       'reader' || (doc_id % 17) || '@example.com' AS to_addr,
       CASE WHEN doc_id % 4 = 0 THEN 'cc' || (doc_id % 9) || '@example.com' ELSE '' END AS cc_addr,
       CASE WHEN doc_id % 6 = 0 THEN 'bcc' || (doc_id % 8) || '@example.com' ELSE '' END
           AS bcc_addr,
       'lang-' || lang AS x_lang,
       text AS subject,
       text,
       n_chars AS size,
       doc_id % 2 = 0 AS seen, doc_id % 5 = 0 AS flagged, doc_id % 7 = 0 AS answered,
       doc_id % 11 = 0 AS draft, doc_id % 13 = 0 AS deleted, doc_id % 3 = 0 AS recent,
       doc_id % 19 = 0 AS kw_work,
       TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(doc_id AS INTEGER)) AS received_ts,
       CASE WHEN doc_id % 10 <> 9
            THEN TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(doc_id AS INTEGER))
                 - INTERVAL 90 MINUTE END AS sent_ts
FROM documents)"""

#: System flags of a row of the SQL ``messages``, space-separated.
FLAGS_TEXT = "concat_ws(' ', " + ", ".join(
    f"CASE WHEN {flag.lower()} THEN '{flag}' END" for flag in SYSTEM_FLAGS
) + ")"


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One small message per event, without any body."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('Events/', event_type) AS folder",
        "event_id + 1 AS uid",
        "CAST(round(value * 100) AS BIGINT) AS size",
        "CAST(ts AS TIMESTAMP) AS received_ts",
        "event_id",
    )


ARRIVALS = """arrivals AS (
SELECT 'Events/' || event_type AS folder, event_id + 1 AS uid, event_id,
       CAST(round(value * 100) AS BIGINT) AS size, ts AS received_ts
FROM events)"""


#: Turns of a conversation that go into one mail, at most.
TURNS_PER_MAIL = 50


def threads_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw multipart mails of conversations: the first turn is the body, others attachments.

    A long conversation goes on in further mails, so that no mail grows without
    end.
    """
    turns = table(spark, sf_dir, "conversations").withColumns({
        "mail": F.floor(F.col("turn") / TURNS_PER_MAIL),
        "place": F.col("turn") % TURNS_PER_MAIL,
    })
    piece = F.concat(
        F.lit("--turnsep\nContent-Type: text/plain; charset=UTF-8\n"
              "Content-Transfer-Encoding: 8bit\n"),
        F.when(
            F.col("place") > 0,
            F.concat(F.lit('Content-Disposition: attachment; filename="turn-'), "turn",
                     F.lit("-"), "role", F.lit('.txt"\n')),
        ).otherwise(F.lit("")),
        F.lit("\n"), "text", F.lit("\n"),
    )
    mails = turns.withColumn("piece", piece).groupBy("conv_id", "mail").agg(
        F.array_sort(F.collect_list(F.struct("turn", "piece"))).alias("pieces")
    )
    raw = F.concat(
        F.lit("From: user"), "conv_id", F.lit("@example.com\nTo: desk@example.com\n"
                                              "Subject: Conversation "), "conv_id",
        F.lit("\nMessage-ID: <conv-"), "conv_id", F.lit("-"), "mail",
        F.lit("@example.com>\nMIME-Version: 1.0\n"
              'Content-Type: multipart/mixed; boundary="turnsep"\n\n'),
        F.array_join(F.transform("pieces", lambda p: p["piece"]), ""),
        F.lit("--turnsep--\n"),
    )
    uid = F.col("mail") * 2**32 + F.col("conv_id") + 1
    return _landed(mails, F.lit("Threads"), uid, raw)


THREADS = f"""threads AS (
SELECT *, turn // {TURNS_PER_MAIL} AS mail, turn % {TURNS_PER_MAIL} AS place,
       (turn // {TURNS_PER_MAIL}) * 4294967296 + conv_id + 1 AS uid,
       '<conv-' || conv_id || '-' || (turn // {TURNS_PER_MAIL}) || '@example.com>' AS mail_id
FROM conversations)"""


def _landed(df: DataFrame, folder: Column, uid: Column, raw: Column) -> DataFrame:
    octets = F.encode(raw, "UTF-8")
    return df.select(
        folder.alias("folder"),
        uid.cast("bigint").alias("uid"),
        F.lit("2024-06-01 00:00:00").cast("timestamp").alias("received_ts"),
        F.octet_length(octets).cast("bigint").alias("size"),
        octets.alias("raw"),
    )


#: Mails of ``mixed_raw`` take one of these forms by document id.
MIXED_FORMS = ["plain", "base64", "quoted", "cut base64", "unknown encoding",
               "nested", "cut attachment", "no from", "broken to", "charset"]


def mixed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw mail per document, in ten forms, some of them faulty.

    The form is the document id modulo ten, see ``MIXED_FORMS``.
    """
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id"), F.col("lang"),
        F.regexp_replace("text", "\r", " ").alias("text"),
    )
    ident = F.col("doc_id").cast("string")
    form = F.col("doc_id") % 10
    packed = F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"\s", "")
    word = F.concat(F.lit("=?UTF-8?B?"),
                    F.base64(F.encode(F.concat(F.lit("é "), ident), "UTF-8")), F.lit("?="))
    subject = (
        F.when(form == 1, F.concat(F.lit("Re: "), word))
        .when(form == 2, F.concat(word, F.lit(" "), word))
        .when(form == 9, F.concat(F.lit("=?x-none?B?eA==?= "), ident))
        .otherwise(F.concat(F.lit("Document "), ident))
    )
    sender = F.when(form == 7, F.lit("")).otherwise(
        F.concat(F.lit('From: "Desk, '), "lang", F.lit('" <desk-'), "lang",
                 F.lit("@example.com>, other@example.com\n"))
    )
    to = F.when(form == 8, F.lit("To: <broken\n")).otherwise(
        F.concat(F.lit("To: reader"), ident, F.lit("@example.com\n"))
    )
    text_part = F.concat(F.lit("--outer\nContent-Type: text/plain; charset=UTF-8\n\n"),
                         "text", F.lit("\n"))

    def file(name: str, encoding: str, data: Column, boundary: str = "outer") -> Column:
        return F.concat(
            F.lit(f"--{boundary}\nContent-Type: Application/X-Data; v=1\n"
                  f"Content-Transfer-Encoding: {encoding}\n"
                  f"Content-Disposition: ATTACHMENT{name}\n\n"), data, F.lit("\n"))

    nested = F.concat(
        F.lit('Content-Type: multipart/mixed; boundary="outer"\n\npreamble\n'),
        text_part,
        file('; filename="=?UTF-8?Q?one=2Ebin?="', "base64", packed),
        F.lit('--outer\nContent-Type: multipart/alternative; boundary="inner"\n\n'),
        F.lit('--inner\nContent-Type: text/plain; name="named.txt"\n\n'), ident, F.lit("\n"),
        F.lit('--inner\nContent-Type: image/png\nContent-Disposition: inline;'
              ' filename="shown.png"\n\nx\n'),
        F.lit("--inner--\n"),
        F.lit("--outer\nContent-Type: message/rfc822\nContent-Disposition: attachment\n\n"
              "Subject: inner "), ident, F.lit("\n\ninner body\n"),
        F.lit("--outer--\n"),
    )
    cut = F.concat(
        F.lit('Content-Type: multipart/mixed; boundary="outer"\n\n'),
        text_part,
        file('; filename="first.txt"', "7bit", ident),
        file('; filename="bad.bin"', "base64", F.lit("QUJD\nQUJ")),
        file('; filename="last.txt"', "7bit", ident),
        F.lit("--outer--\n"),
    )
    body = (
        F.when(form == 1, F.concat(F.lit("Content-Transfer-Encoding: base64\n\n"), packed))
        .when(form == 2, F.concat(F.lit("Content-Transfer-Encoding: Quoted-Printable\n\n"),
                                  F.lit("caf=C3=A9 "), ident, F.lit("=\n!")))
        .when(form == 3, F.concat(F.lit("Content-Transfer-Encoding: base64\n\n"), F.lit("QUJDQ")))
        .when(form == 4, F.concat(F.lit("Content-Transfer-Encoding: x-rot13\n\n"), ident))
        .when(form == 5, nested)
        .when(form == 6, cut)
        .otherwise(F.concat(F.lit("\n"), F.col("text")))
    )
    raw = F.concat(
        F.lit("Subject: "), subject, F.lit("\n"), sender, to,
        F.lit("Date: Tue, 16 Jan 2024 14:30:00 +0200\nMessage-ID: <mixed-"), ident,
        F.lit("@example.com>\nIn-Reply-To:\n <parent-"), ident, F.lit("@example.com>\n"), body,
    )
    return _landed(docs, F.concat(F.lit("Mixed/"), F.col("lang")), F.col("doc_id") + 1, raw)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fetch request per customer, some of them waiting, spent or invalid."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS request_id",
        "CASE WHEN c_custkey % 41 = 0 THEN ' ' WHEN c_custkey % 43 = 0 THEN 'Missing' "
        "WHEN c_custkey % 3 = 0 THEN concat('Archive/src', c_custkey % 20, '*') "
        "ELSE concat('Archive/src', c_custkey % 20, '/en') END AS folder",
        "c_custkey % 3 = 0 AS recursive",
        "CASE WHEN c_custkey % 37 = 0 THEN 0 WHEN c_custkey % 5 = 0 THEN 2 ELSE -1 END "
        "AS max_recursion_depth",
        "CASE WHEN c_custkey % 2 = 0 THEN 'shared' END AS state_folder",
        "CAST(CASE WHEN c_custkey % 31 = 0 THEN 0 WHEN c_custkey % 4 <> 0 THEN c_custkey % 4 END "
        "AS INT) AS batch_size",
        "CASE WHEN c_custkey % 7 = 0 THEN 'HEADERS_ONLY' "
        "WHEN c_custkey % 29 = 0 THEN 'ATTACHMENTS_ONLY' END AS fetch_mode",
        "c_custkey % 6 <> 1 AS include_headers",
        "c_custkey % 5 = 2 AS include_attachments",
        "c_custkey % 2 = 0 AS incremental",
        "CAST(CASE WHEN c_custkey % 23 = 0 THEN -1 WHEN c_custkey % 2 = 1 THEN 5000 END "
        "AS BIGINT) AS max_message_size",
        "CAST(if(c_custkey % 15 = 7, 0, 4000) AS BIGINT) AS max_attachment_size",
        "CASE WHEN c_custkey % 35 = 2 THEN 0 END AS max_attachments",
        "CAST(if(c_custkey % 19 = 0, -1, c_custkey % 4) AS INT) AS max_retries",
        "CAST(if(c_custkey % 17 = 0, 0, 1000) AS BIGINT) AS retry_backoff_ms",
        "CAST(CASE WHEN c_custkey % 8 <> 0 THEN c_custkey % 5 END AS INT) AS retry_count",
        "CASE WHEN c_custkey % 9 <> 0 THEN 1000000 - (c_custkey % 16) * 1000 END "
        "AS retry_last_time_ms",
    )


NOW_MS = 1_000_000

REQUESTS = """raw_requests AS (
SELECT c_custkey AS request_id,
       CASE WHEN c_custkey % 41 = 0 THEN ' ' WHEN c_custkey % 43 = 0 THEN 'Missing'
            WHEN c_custkey % 3 = 0 THEN 'Archive/src' || (c_custkey % 20) || '*'
            ELSE 'Archive/src' || (c_custkey % 20) || '/en' END AS folder,
       c_custkey % 3 = 0 AS recursive,
       CASE WHEN c_custkey % 37 = 0 THEN 0 WHEN c_custkey % 5 = 0 THEN 2 ELSE -1 END
           AS max_recursion_depth,
       CASE WHEN c_custkey % 2 = 0 THEN 'shared' END AS state_folder,
       CASE WHEN c_custkey % 31 = 0 THEN 0 WHEN c_custkey % 4 <> 0 THEN c_custkey % 4 END
           AS batch_size,
       CASE WHEN c_custkey % 7 = 0 THEN 'HEADERS_ONLY'
            WHEN c_custkey % 29 = 0 THEN 'ATTACHMENTS_ONLY' END AS fetch_mode,
       c_custkey % 6 <> 1 AS include_headers,
       c_custkey % 5 = 2 AS include_attachments,
       c_custkey % 2 = 0 AS incremental,
       CASE WHEN c_custkey % 23 = 0 THEN -1 WHEN c_custkey % 2 = 1 THEN 5000 END
           AS max_message_size,
       CASE WHEN c_custkey % 15 = 7 THEN 0 ELSE 4000 END AS max_attachment_size,
       CASE WHEN c_custkey % 35 = 2 THEN 0 END AS max_attachments,
       CASE WHEN c_custkey % 19 = 0 THEN -1 ELSE c_custkey % 4 END AS max_retries,
       CASE WHEN c_custkey % 17 = 0 THEN 0 ELSE 1000 END AS retry_backoff_ms,
       CASE WHEN c_custkey % 8 <> 0 THEN c_custkey % 5 END AS retry_count,
       CASE WHEN c_custkey % 9 <> 0 THEN 1000000 - (c_custkey % 16) * 1000 END
           AS retry_last_time_ms
FROM customer),
requests AS (
SELECT request_id, folder, recursive,
       CAST(max_recursion_depth AS INTEGER) AS max_recursion_depth,
       coalesce(state_folder, 'INBOX') AS state_folder,
       CAST(coalesce(batch_size, 10) AS INTEGER) AS batch_size,
       coalesce(fetch_mode, 'FULL_MESSAGE') AS fetch_mode,
       include_headers, include_attachments, incremental,
       CAST(coalesce(max_message_size, 104857600) AS BIGINT) AS max_message_size,
       CASE WHEN include_attachments THEN CAST(max_attachment_size AS BIGINT)
            ELSE 9223372036854775807 END AS max_attachment_size,
       CAST(CASE WHEN include_attachments THEN coalesce(max_attachments, 100)
            ELSE 2147483647 END AS INTEGER) AS max_attachments,
       CAST(max_retries AS INTEGER) AS max_retries,
       CAST(retry_backoff_ms AS BIGINT) AS retry_backoff_ms,
       CAST(retry_count AS INTEGER) AS retry_count,
       CAST(retry_last_time_ms AS BIGINT) AS retry_last_time_ms
FROM raw_requests)"""


def cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursors halfway through each folder; French folders have none yet."""
    return (
        messages(spark, sf_dir).filter(~F.endswith("folder", F.lit("/fr")))
        .groupBy("folder").agg(F.floor(F.max("uid") / 2).alias("last_uid"))
        .select(F.lit("shared").alias("state_folder"), "folder", "last_uid")
    )


CURSORS = """cursors AS (
SELECT 'shared' AS state_folder, folder, max(uid) // 2 AS last_uid
FROM messages WHERE NOT ends_with(folder, '/fr')
GROUP BY folder)"""
