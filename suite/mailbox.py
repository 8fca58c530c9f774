"""Projection, folders, cursors, caps, routes and mailbox updates."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from mailloom import FetchOptions
from mailloom.functions.text import state_key
from mailloom.operators import criteria as c
from mailloom.operators.cursor import (
    advance_cursor,
    after_cursor,
    effective_id,
    highest_uid,
    load_cursors,
    with_state_key,
)
from mailloom.operators.folders import (
    folder_depth,
    folder_table,
    in_folder,
    reachable_folders,
)
from mailloom.operators.joins import materialise
from mailloom.operators.limits import batch_number, cap_per_folder
from mailloom.operators.mailbox import expunge, flag_deleted, mark_read, resolve, with_marks
from mailloom.operators.project import (
    project_base,
    project_headers,
    with_attributes,
    with_batch_id,
)
from mailloom.operators.summary import run_summary
from mailloom.plans.fetch import fetch, split_oversize, with_outcome
from mailloom.plans.poll import poll, run_step
from mailloom.schema import ATTACHMENTS_ONLY, HEADERS_ONLY
from mailloom.sources.sinks import read_mark_steps
from suite import views
from suite.scratch import scratch
from suite.views import ARRIVALS, CURSORS, FLAGS_TEXT, MESSAGES

# -- projection ---------------------------------------------------------------


def headers_projection(spark, sf_dir):
    df = with_batch_id(views.messages(spark, sf_dir), "run-1")
    return project_headers(df).withColumns({
        "received_ts": F.unix_millis("received_ts"),
        "sent_ts": F.coalesce(F.unix_millis("sent_ts"), F.lit(-1)),
    })


_HEADERS = f"""WITH {MESSAGES}
SELECT subject, sender, to_addr, cc_addr, epoch_ms(received_ts) AS received_ts,
       coalesce(epoch_ms(sent_ts), -1) AS sent_ts, {FLAGS_TEXT} AS flags, size, message_id,
       '' AS in_reply_to, 'run-1' AS batch_id, folder, uid
FROM messages"""


def base_projection(spark, sf_dir):
    return project_base(with_batch_id(views.messages(spark, sf_dir), "run-1"))


def attribute_map(spark, sf_dir):
    df = project_headers(with_batch_id(views.messages(spark, sf_dir), "run-1"))
    entries = F.array_sort(F.transform(
        F.map_entries("attributes"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    ))
    return with_attributes(df).select(
        "folder", "uid", F.array_join(entries, "|").alias("attributes")
    )


_ATTRIBUTES = f"""WITH {MESSAGES}, lines AS (
SELECT folder, uid, unnest([
  'email.subject=' || subject, 'email.from=' || sender, 'email.to=' || to_addr,
  'email.cc=' || cc_addr, 'email.received.date=' || epoch_ms(received_ts),
  'email.sent.date=' || coalesce(CAST(epoch_ms(sent_ts) AS VARCHAR), ''),
  'email.flags=' || {FLAGS_TEXT}, 'email.size=' || size,
  'email.message.id=' || message_id, 'email.in.reply.to=', 'email.batch.id=run-1',
  'email.folder=' || folder, 'email.uid=' || uid]) AS line
FROM messages)
SELECT folder, uid, string_agg(line, '|' ORDER BY line) AS attributes
FROM lines GROUP BY folder, uid"""


def flags_text(spark, sf_dir):
    df = project_headers(views.messages(spark, sf_dir))
    return df.groupBy("flags").agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("first_uid"))


_FLAGS = f"""WITH {MESSAGES}
SELECT {FLAGS_TEXT} AS flags, count(*) AS n, min(uid) AS first_uid
FROM messages GROUP BY 1"""


# -- folders ------------------------------------------------------------------


def folder_select(spark, sf_dir):
    df = views.messages(spark, sf_dir)
    exact = in_folder(df, "Archive/src3/en").select(F.lit("exact").alias("rule"), "folder", "uid")
    no_star = in_folder(df, "Archive/src3", recursive=True).select(
        F.lit("no star").alias("rule"), "folder", "uid"
    )
    star = in_folder(df, "Archive/src1*", recursive=True).select(
        F.lit("star").alias("rule"), "folder", "uid"
    )
    shallow = in_folder(df, "Archive*", recursive=True, max_depth=2).select(
        F.lit("shallow").alias("rule"), "folder", "uid"
    )
    deep = in_folder(df, "*", recursive=True, max_depth=3).select(
        F.lit("deep").alias("rule"), "folder", "uid"
    )
    return exact.unionByName(no_star).unionByName(star).unionByName(shallow).unionByName(deep)


_FOLDER_SELECT = f"""WITH {MESSAGES}
SELECT 'exact' AS rule, folder, uid FROM messages WHERE folder = 'Archive/src3/en'
UNION ALL SELECT 'star', folder, uid FROM messages WHERE starts_with(folder, 'Archive/src1')
UNION ALL SELECT 'deep', folder, uid FROM messages"""


def folder_depths(spark, sf_dir):
    tree = folder_table(views.messages(spark, sf_dir))
    return tree.select("path", "depth", folder_depth(F.col("path")).alias("computed"),
                       "holds_messages", "holds_folders")


_FOLDER_DEPTHS = f"""WITH {MESSAGES}, used AS (SELECT DISTINCT folder FROM messages)
SELECT folder AS path, 3 AS depth, 3 AS computed, true AS holds_messages,
       false AS holds_folders FROM used
UNION ALL SELECT DISTINCT regexp_replace(folder, '/[^/]*$', ''), 2, 2, false, true FROM used
UNION ALL SELECT 'Archive', 1, 1, false, true UNION ALL SELECT '', 0, 0, false, true"""


def _tree(spark, sf_dir):
    """The folder tree in which src1 and src2 also hold messages themselves."""
    tree = folder_table(views.messages(spark, sf_dir))
    return materialise(tree.withColumn(
        "holds_messages",
        F.col("holds_messages") | F.col("path").isin("Archive/src1", "Archive/src2"),
    ))


def reachable(spark, sf_dir):
    return reachable_folders(_tree(spark, sf_dir)).select("path", "depth")


_REACHABLE = f"""WITH {MESSAGES}, used AS (SELECT DISTINCT folder FROM messages)
SELECT folder AS path, 3 AS depth FROM used
WHERE NOT starts_with(folder, 'Archive/src1/') AND NOT starts_with(folder, 'Archive/src2/')
UNION ALL SELECT DISTINCT regexp_replace(folder, '/[^/]*$', ''), 2 FROM used
UNION ALL SELECT 'Archive', 1 UNION ALL SELECT '', 0"""


def recursive_fetch(spark, sf_dir):
    """A recursive run passes by folders it cannot reach."""
    options = FetchOptions(folder="Archive/*", recursive=True, fetch_mode=HEADERS_ONLY,
                           batch_size=2, max_message_size=4000)
    run = fetch(views.messages(spark, sf_dir), options, folders=_tree(spark, sf_dir))
    return run.success.select("folder", "uid", "size")


_RECURSIVE = f"""WITH {MESSAGES}, ranked AS (
SELECT folder, uid, size, row_number() OVER (PARTITION BY folder ORDER BY uid) AS r
FROM messages WHERE size <= 4000 AND NOT starts_with(folder, 'Archive/src1/')
  AND NOT starts_with(folder, 'Archive/src2/'))
SELECT folder, uid, size FROM ranked WHERE r <= 20"""

# -- cursors ------------------------------------------------------------------


def cursor_filter(spark, sf_dir):
    kept = after_cursor(
        views.messages(spark, sf_dir), views.cursors(spark, sf_dir), state_folder="shared"
    )
    return kept.select("folder", "uid")


_CURSOR_FILTER = f"""WITH {MESSAGES}, {CURSORS}
SELECT m.folder, m.uid FROM messages m LEFT JOIN cursors c ON m.folder = c.folder
WHERE c.last_uid IS NULL OR m.uid > c.last_uid"""


def cursor_literal(spark, sf_dir):
    """Cursors of a few folders, given as numbers."""
    kept = after_cursor(
        views.messages(spark, sf_dir), {"Archive/src1/en": 300, "Archive/src2/en": 100}
    )
    return kept.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n"), F.min("uid").alias("first_uid")
    )


_CURSOR_LITERAL = f"""WITH {MESSAGES}
SELECT folder, count(*) AS n, min(uid) AS first_uid FROM messages
WHERE NOT (folder = 'Archive/src1/en' AND uid <= 300)
  AND NOT (folder = 'Archive/src2/en' AND uid <= 100) GROUP BY folder"""


def cursor_highest(spark, sf_dir):
    routed = with_outcome(views.arrivals(spark, sf_dir), 10000, HEADERS_ONLY)
    return highest_uid(routed.filter(F.col("relationship") == "success"))


_CURSOR_HIGHEST = f"""WITH {ARRIVALS}
SELECT folder, max(uid) AS last_uid FROM arrivals WHERE greatest(size, 0) <= 10000
GROUP BY folder"""


def cursor_advance(spark, sf_dir):
    """Cursors merged with those of a run that saw only the flagged messages."""
    run = highest_uid(c.search(views.messages(spark, sf_dir), all_of=[c.flagged()]))
    return advance_cursor(views.cursors(spark, sf_dir), run, "shared")


_CURSOR_ADVANCE = f"""WITH {MESSAGES}, {CURSORS}, merged AS (
SELECT * FROM cursors UNION ALL
SELECT 'shared', folder, max(uid) FROM messages WHERE flagged GROUP BY folder)
SELECT state_folder, folder, max(last_uid) AS last_uid FROM merged GROUP BY ALL"""


def cursor_load(spark, sf_dir):
    """Stored texts that are no numbers are no cursors."""
    stored = views.cursors(spark, sf_dir).withColumn(
        "last_uid",
        F.when(F.col("last_uid") % 3 == 0, F.concat(F.col("last_uid").cast("string"), F.lit("x")))
        .otherwise(F.col("last_uid").cast("string")),
    )
    return load_cursors(stored)


_CURSOR_LOAD = f"""WITH {MESSAGES}, {CURSORS}
SELECT state_folder, folder, last_uid FROM cursors WHERE last_uid % 3 <> 0"""


def state_keys(spark, sf_dir):
    keyed = with_state_key(views.cursors(spark, sf_dir))
    return keyed.select(
        "folder", "state_key",
        state_key(F.lit(None).cast("string"), F.lit("Archive*"), F.col("folder"))
        .alias("target_key"),
    )


_STATE_KEYS = f"""WITH {MESSAGES}, {CURSORS}
SELECT folder, 'lastUID_shared_' || replace(folder, '/', '_') AS state_key,
       'lastUID_Archive*_' || replace(folder, '/', '_') AS target_key FROM cursors"""


def effective_ids(spark, sf_dir):
    """Message numbers stand in where a message has no UID."""
    numbered = views.arrivals(spark, sf_dir).withColumns({
        "msg_num": F.col("uid") + 7,
        "uid": F.when(F.col("uid") % 3 == 0, F.lit(-1)).when(F.col("uid") % 3 == 1, F.col("uid")),
    })
    kept = after_cursor(numbered, {"Events/click": 500, "Events/error": -1})
    return kept.select("folder", effective_id().alias("id"), "event_id")


_EFFECTIVE = f"""WITH {ARRIVALS}, ids AS (
SELECT folder, CASE WHEN uid % 3 = 1 THEN uid ELSE uid + 7 END AS id, event_id FROM arrivals)
SELECT folder, id, event_id FROM ids WHERE folder <> 'Events/click' OR id > 500"""


def poll_twice(spark, sf_dir):
    """Two triggers: the second one goes on above the cursors of the first."""
    mails = views.arrivals(spark, sf_dir)
    bare = _enveloped(mails)
    options = FetchOptions(folder="Events/*", recursive=True, incremental=True, batch_size=20,
                           state_folder="s", fetch_mode=HEADERS_ONLY, max_message_size=10000)
    none = spark.createDataFrame([], "state_folder string, folder string, last_uid long")
    first = poll(bare, none, options, batch_id="first")
    second = poll(bare, materialise(first.cursors), options, batch_id="second")
    return first.fetched.success.unionByName(second.fetched.success).select(
        "batch_id", "folder", "uid"
    )


_POLL_TWICE = f"""WITH {ARRIVALS}, ranked AS (
SELECT folder, uid, row_number() OVER (PARTITION BY folder ORDER BY uid) AS r
FROM arrivals WHERE greatest(size, 0) <= 10000)
SELECT CASE WHEN r <= 200 THEN 'first' ELSE 'second' END AS batch_id, folder, uid
FROM ranked WHERE r <= 400"""


def poll_steps(spark, sf_dir):
    """Three triggers that find their cursors on disk; the second one is run twice."""
    base = scratch(spark)
    bare = _enveloped(views.arrivals(spark, sf_dir))
    options = FetchOptions(folder="Events/*", recursive=True, incremental=True, batch_size=12,
                           state_folder="s", fetch_mode=HEADERS_ONLY, max_message_size=10000)
    for step in (0, 1, 1, 2):
        run_step(bare, step, f"{base}/out", f"{base}/cursors", options)
    return spark.read.parquet(f"{base}/out").select("step", "relationship", "folder", "uid")


_POLL_STEPS = f"""WITH {ARRIVALS}, counted AS (
SELECT folder, uid, greatest(size, 0) <= 10000 AS ok,
  coalesce(sum(CASE WHEN greatest(size, 0) <= 10000 THEN 1 ELSE 0 END) OVER (
    PARTITION BY folder ORDER BY uid
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
FROM arrivals)
SELECT CAST(before // 120 AS INTEGER) AS step,
  CASE WHEN ok THEN 'success' ELSE 'parse-error' END AS relationship, folder, uid
FROM counted WHERE before < 360"""


def poll_marks(spark, sf_dir):
    """Triggers that take the unread and mark them as read, then triggers that delete.

    One step of each kind is run twice.
    """
    base = scratch(spark)
    bare = _enveloped(views.arrivals(spark, sf_dir))
    options = FetchOptions(folder="Events/*", recursive=True, batch_size=5, state_folder="s",
                           fetch_mode=HEADERS_ONLY)
    for kind in ("mark_read", "delete_messages"):
        chosen = replace(options, **{kind: True})
        for step in (0, 1, 1, 2):
            run_step(bare, step, f"{base}/{kind}", f"{base}/state-{kind}", chosen, [c.unseen()])
    shown = [
        spark.read.parquet(f"{base}/{kind}").select(F.lit(kind).alias("kind"), "step", "folder", "uid")
        for kind in ("mark_read", "delete_messages")
    ]
    left = with_marks(
        bare.select("folder", "uid", "flags"),
        read_mark_steps(spark, f"{base}/state-delete_messages", before=3),
    ).select(F.lit("left").alias("kind"), F.lit(3).alias("step"), "folder", "uid")
    return shown[0].unionByName(shown[1]).unionByName(left)


_POLL_MARKS = f"""WITH {ARRIVALS}, ranked AS (
SELECT folder, uid, row_number() OVER (PARTITION BY folder ORDER BY uid) - 1 AS r
FROM arrivals)
SELECT kind, CAST(r // 50 AS INTEGER) AS step, folder, uid
FROM ranked, (VALUES ('mark_read'), ('delete_messages')) AS k(kind) WHERE r < 150
UNION ALL SELECT 'left', 3, folder, uid FROM ranked WHERE r >= 150"""


def _enveloped(df):
    """Arrivals with the empty header columns a projection asks for."""
    text, texts = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    return df.withColumns({
        "subject": text, "message_id": text, "flags": texts, "from_all": texts,
        "to_all": texts, "cc_all": texts, "sent_ts": F.lit(None).cast("timestamp"),
    })

# -- caps and batches ---------------------------------------------------------


def cap_per_run(spark, sf_dir):
    routed = with_outcome(views.arrivals(spark, sf_dir), 20000, HEADERS_ONLY)
    return cap_per_folder(routed, 10, F.col("relationship") == "success").select(
        "folder", "uid", "relationship"
    )


_CAP = f"""WITH {ARRIVALS}, counted AS (
SELECT folder, uid, greatest(size, 0) <= 20000 AS ok,
       coalesce(sum(CASE WHEN greatest(size, 0) <= 20000 THEN 1 ELSE 0 END) OVER (
           PARTITION BY folder ORDER BY uid
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
FROM arrivals)
SELECT folder, uid, CASE WHEN ok THEN 'success' ELSE 'parse-error' END AS relationship
FROM counted WHERE before < 100"""


def batch_numbers(spark, sf_dir):
    df = views.arrivals(spark, sf_dir)
    return batch_number(df, 7, F.col("size") <= 20000).select("folder", "uid", "batch_number")


_BATCHES = f"""WITH {ARRIVALS}, ranked AS (
SELECT folder, uid, row_number() OVER (PARTITION BY folder ORDER BY uid) AS r
FROM arrivals WHERE size <= 20000)
SELECT folder, uid, (r - 1) // 7 AS batch_number FROM ranked WHERE r <= 70"""


def cap_large(spark, sf_dir):
    """A cap of 1,500 messages, above half of the largest folder at the smaller sizes."""
    routed = with_outcome(views.arrivals(spark, sf_dir), 20000, HEADERS_ONLY)
    return cap_per_folder(routed, 150, F.col("relationship") == "success").select(
        "folder", "uid", "relationship"
    )


def batches_large(spark, sf_dir):
    df = views.arrivals(spark, sf_dir)
    return batch_number(df, 150, F.col("size") <= 20000).select("folder", "uid", "batch_number")


def batch_stamp(spark, sf_dir):
    df = with_batch_id(views.messages(spark, sf_dir), "run-7")
    return df.groupBy("batch_id", "folder").agg(F.count(F.lit(1)).alias("n"))

# -- routes -------------------------------------------------------------------


def oversize_route(spark, sf_dir):
    _, errors = split_oversize(views.arrivals(spark, sf_dir), 10000)
    return errors


_OVERSIZE = f"""WITH {ARRIVALS}
SELECT folder, uid, 'MESSAGE_TOO_LARGE' AS error_type,
       'Message size ' || size || ' exceeds limit 10000' AS error_message
FROM arrivals WHERE size > 10000"""


def routes(spark, sf_dir):
    """Every row of a run, tagged with the output it goes to."""
    options = FetchOptions(folder="Archive/*", recursive=True, batch_size=3,
                           max_message_size=5000)
    run = fetch(views.messages(spark, sf_dir), options, all_of=[c.undeleted()], batch_id="b")
    return run.tagged().select(
        "relationship", "folder", "uid",
        F.coalesce(F.col("attributes")["error.type"], F.lit("")).alias("error_type"),
        F.coalesce(F.col("attributes")["email.subject"], F.lit("")).alias("subject"),
        F.coalesce(F.md5("content"), F.lit("")).alias("content_md5"),
    )


_ROUTES = f"""WITH {MESSAGES}, counted AS (
SELECT *, size <= 5000 AS ok,
       coalesce(sum(CASE WHEN size <= 5000 THEN 1 ELSE 0 END) OVER (
           PARTITION BY folder ORDER BY uid
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
FROM messages WHERE NOT deleted)
SELECT CASE WHEN ok THEN 'success' ELSE 'parse-error' END AS relationship, folder, uid,
       CASE WHEN ok THEN '' ELSE 'MESSAGE_TOO_LARGE' END AS error_type,
       CASE WHEN ok THEN subject ELSE '' END AS subject,
       CASE WHEN ok THEN md5(text) ELSE '' END AS content_md5
FROM counted WHERE before < 30"""


def fetch_modes(spark, sf_dir):
    """What each mode shows of the same messages."""
    def shown(mode, headers):
        options = FetchOptions(folder="Archive/*", recursive=True, fetch_mode=mode,
                               include_headers=headers, include_attachments=True,
                               max_attachment_size=4000)
        run = fetch(views.messages(spark, sf_dir), options, capped=False)
        rows = run.success
        have = rows.columns
        return rows.select(
            F.lit(mode).alias("mode"), F.lit(headers).alias("headers"), "folder", "uid",
            (F.col("subject") if "subject" in have else F.lit("-")).alias("subject"),
            (F.md5("content") if "content" in have else F.lit("-")).alias("content_md5"),
        )

    return (
        shown(HEADERS_ONLY, True).unionByName(shown("FULL_MESSAGE", True))
        .unionByName(shown("FULL_MESSAGE", False)).unionByName(shown(ATTACHMENTS_ONLY, False))
    )


_FETCH_MODES = f"""WITH {MESSAGES}, chosen AS (SELECT * FROM messages)
SELECT 'HEADERS_ONLY' AS mode, true AS headers, folder, uid, subject, '-' AS content_md5
FROM chosen
UNION ALL SELECT 'FULL_MESSAGE', true, folder, uid, subject, md5(text) FROM chosen
UNION ALL SELECT 'FULL_MESSAGE', false, folder, uid, '-', md5(text) FROM chosen
UNION ALL SELECT 'ATTACHMENTS_ONLY', false, folder, uid, '-', '-' FROM chosen"""


def new_large_messages(spark, sf_dir):
    """New large messages of some folders, as headers, each with its next cursor."""
    options = FetchOptions(folder="Archive/src*", recursive=True, incremental=True,
                           state_folder="shared", fetch_mode=HEADERS_ONLY)
    run = fetch(
        views.messages(spark, sf_dir), options,
        all_of=[c.larger(1000)], any_of=[c.subject("an"), c.subject("th"), c.flagged()],
        cursors=views.cursors(spark, sf_dir), batch_id="run-1", capped=False,
    )
    return run.success.select("folder", "uid", "sender", "subject", "size", "flags").join(
        run.cursors, "folder"
    )


_NEW_LARGE = f"""WITH {MESSAGES}, {CURSORS}, hits AS (
SELECT m.* FROM messages m LEFT JOIN cursors c ON m.folder = c.folder
WHERE (c.last_uid IS NULL OR m.uid > c.last_uid) AND size > 1000
  AND (contains(lower(subject), 'an') OR contains(lower(subject), 'th') OR flagged))
SELECT folder, uid, sender, subject, size, {FLAGS_TEXT} AS flags,
       max(uid) OVER (PARTITION BY folder) AS last_uid FROM hits"""


def run_counts(spark, sf_dir):
    options = FetchOptions(folder="Archive/*", recursive=True, incremental=True,
                           state_folder="shared")
    run = fetch(views.messages(spark, sf_dir), options, all_of=[c.unseen()],
                cursors=views.cursors(spark, sf_dir), capped=False)
    return run.summary.withColumn("folder", F.coalesce("folder", F.lit("(total)")))


_RUN_COUNTS = f"""WITH {MESSAGES}, {CURSORS}, hits AS (
SELECT m.folder FROM messages m LEFT JOIN cursors c ON m.folder = c.folder
WHERE (c.last_uid IS NULL OR m.uid > c.last_uid) AND NOT seen)
SELECT folder, count(*) AS processed, true AS had_messages FROM hits GROUP BY folder
UNION ALL SELECT '(total)', count(*), count(*) > 0 FROM hits"""


def run_counts_none(spark, sf_dir):
    none = c.search(views.messages(spark, sf_dir), all_of=[c.larger(2**31 - 1)])
    return run_summary(none).withColumn("folder", F.coalesce("folder", F.lit("(total)")))


_RUN_COUNTS_NONE = f"""WITH {MESSAGES}
SELECT '(total)' AS folder, count(*) AS processed, count(*) > 0 AS had_messages
FROM messages WHERE size > 2147483647"""

# -- mailbox updates ----------------------------------------------------------


def _shown(df):
    return project_headers(df).select("folder", "uid", "flags")


def _with_flag(name: str, done: str) -> str:
    return FLAGS_TEXT.replace(f"WHEN {name.lower()} THEN", f"WHEN {name.lower()} OR {done} THEN")


def read_marks(spark, sf_dir):
    mails = views.messages(spark, sf_dir)
    return _shown(mark_read(mails, c.search(mails, all_of=[c.larger(1500)])))


_READ_MARKS = f"""WITH {MESSAGES}
SELECT folder, uid, {_with_flag('SEEN', 'size > 1500')} AS flags FROM messages"""


def delete_marks(spark, sf_dir):
    mails = views.messages(spark, sf_dir)
    return _shown(flag_deleted(mails, c.search(mails, all_of=[c.answered()])))


_DELETE_MARKS = f"""WITH {MESSAGES}
SELECT folder, uid, {_with_flag('DELETED', 'answered')} AS flags FROM messages"""


def expunged(spark, sf_dir):
    """Folders with a delivered message lose everything flagged as deleted."""
    mails = views.messages(spark, sf_dir)
    done = c.search(mails, all_of=[c.larger(4000), c.answered()])
    return _shown(expunge(flag_deleted(mails, done), done))


_EXPUNGED = f"""WITH {MESSAGES}, touched AS (
SELECT DISTINCT folder FROM messages WHERE size > 4000 AND answered)
SELECT folder, uid, {FLAGS_TEXT} AS flags FROM messages
WHERE NOT ((deleted OR (size > 4000 AND answered)) AND folder IN (SELECT folder FROM touched))"""


def resolved(spark, sf_dir):
    """Looking up UIDs, some of which no longer exist."""
    mails = views.messages(spark, sf_dir)
    ids = mails.select("folder", (F.col("uid") * 2).alias("uid"))
    return resolve(ids, mails).select("folder", "uid", "size")


_RESOLVED = f"""WITH {MESSAGES}
SELECT m.folder, m.uid, m.size FROM messages m
WHERE (m.folder, m.uid) IN (SELECT folder, uid * 2 FROM messages)"""


QUERIES = {
    "headers_projection": (headers_projection, _HEADERS),
    "base_projection": (
        base_projection,
        f"WITH {MESSAGES} SELECT 'run-1' AS batch_id, folder, uid FROM messages",
    ),
    "attribute_map": (attribute_map, _ATTRIBUTES),
    "flags_text": (flags_text, _FLAGS),
    "folder_select": (folder_select, _FOLDER_SELECT),
    "folder_depths": (folder_depths, _FOLDER_DEPTHS),
    "reachable": (reachable, _REACHABLE),
    "recursive_fetch": (recursive_fetch, _RECURSIVE),
    "cursor_filter": (cursor_filter, _CURSOR_FILTER),
    "cursor_literal": (cursor_literal, _CURSOR_LITERAL),
    "cursor_highest": (cursor_highest, _CURSOR_HIGHEST),
    "cursor_advance": (cursor_advance, _CURSOR_ADVANCE),
    "cursor_load": (cursor_load, _CURSOR_LOAD),
    "state_keys": (state_keys, _STATE_KEYS),
    "effective_ids": (effective_ids, _EFFECTIVE),
    "poll_twice": (poll_twice, _POLL_TWICE),
    "poll_steps": (poll_steps, _POLL_STEPS),
    "poll_marks": (poll_marks, _POLL_MARKS),
    "cap_per_run": (cap_per_run, _CAP),
    "batch_numbers": (batch_numbers, _BATCHES),
    "cap_large": (cap_large, _CAP.replace("before < 100", "before < 1500")),
    "batches_large": (
        batches_large, _BATCHES.replace("// 7", "// 150").replace("r <= 70", "r <= 1500")
    ),
    "batch_stamp": (
        batch_stamp,
        f"WITH {MESSAGES} SELECT 'run-7' AS batch_id, folder, count(*) AS n "
        "FROM messages GROUP BY folder",
    ),
    "oversize_route": (oversize_route, _OVERSIZE),
    "routes": (routes, _ROUTES),
    "fetch_modes": (fetch_modes, _FETCH_MODES),
    "new_large_messages": (new_large_messages, _NEW_LARGE),
    "run_counts": (run_counts, _RUN_COUNTS),
    "run_counts_none": (run_counts_none, _RUN_COUNTS_NONE),
    "read_marks": (read_marks, _READ_MARKS),
    "delete_marks": (delete_marks, _DELETE_MARKS),
    "expunged": (expunged, _EXPUNGED),
    "resolved": (resolved, _RESOLVED),
}
