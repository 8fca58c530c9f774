"""The poll loop as a stream, over arrivals that land in three waves."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailloom import FetchOptions
from mailloom.schema import HEADERS_ONLY
from mailloom.sources.sinks import read_cursor_steps, step_counts
from mailloom.streaming.incremental import cursor_stream, incremental_stream
from suite import views
from suite.mailbox import _enveloped
from suite.scratch import scratch
from suite.views import ARRIVALS

WAVES = 3


def _waves(spark, sf_dir):
    """Arrivals in the order of their time; one in ten lands only with the last wave."""
    mails = _enveloped(views.arrivals(spark, sf_dir))
    top = views.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    return mails.withColumn(
        "wave",
        F.when(F.col("event_id") % 10 == 3, F.lit(WAVES - 1))
        .otherwise(F.floor(F.col("event_id") * WAVES / (top + 1))).cast("int"),
    )


def stream_incremental(spark, sf_dir):
    """The stream is stopped and started again for every wave.

    What lands late, below the cursor of its folder, is passed over.
    """
    return spark.read.parquet(_streamed(spark, sf_dir)).select(
        "step", "relationship", "folder", "uid"
    )


def stream_counts(spark, sf_dir):
    """Messages of each step per folder and in total, from what the steps wrote."""
    out = _streamed(spark, sf_dir)
    steps = [
        step_counts(spark, f"{out}/step={step}").withColumn("step", F.lit(step))
        for step in range(WAVES)
    ]
    return steps[0].unionByName(steps[1]).unionByName(steps[2]).withColumn(
        "folder", F.coalesce("folder", F.lit("(total)"))
    )


def _streamed(spark, sf_dir) -> str:
    """Where the stream of all waves has its outputs."""
    base = scratch(spark)
    waves = _waves(spark, sf_dir)
    schema = waves.drop("wave").schema
    options = FetchOptions(folder="Events/*", recursive=True, incremental=True,
                           fetch_mode=HEADERS_ONLY, max_message_size=10000)
    for wave in range(WAVES):
        waves.filter(F.col("wave") == wave).drop("wave").write.mode("append").parquet(f"{base}/in")
        incremental_stream(
            spark.readStream.schema(schema).parquet(f"{base}/in"),
            f"{base}/out", f"{base}/cursors", f"{base}/checkpoint", options,
        ).awaitTermination()
    return f"{base}/out"


_WAVES = f"""{ARRIVALS}, waves AS (
SELECT *, CASE WHEN event_id % 10 = 3 THEN {WAVES - 1}
  ELSE event_id * {WAVES} // ((SELECT max(event_id) FROM events) + 1) END AS wave,
  greatest(size, 0) <= 10000 AS ok FROM arrivals)"""

_STREAM = f"""WITH {_WAVES}, reached AS (
SELECT folder, wave, max(uid) AS last_uid FROM waves WHERE ok GROUP BY ALL)
SELECT CAST(w.wave AS INTEGER) AS step,
  CASE WHEN ok THEN 'success' ELSE 'parse-error' END AS relationship, w.folder, w.uid
FROM waves w
WHERE NOT EXISTS (SELECT 1 FROM reached r
                  WHERE r.folder = w.folder AND r.wave < w.wave AND r.last_uid >= w.uid)"""


_COUNTS = f"""WITH found AS ({_STREAM})
SELECT step, folder, count(*) AS processed, true AS had_messages FROM found GROUP BY ALL
UNION ALL
SELECT CAST(s.step AS INTEGER), '(total)', count(f.step), count(f.step) > 0
FROM range({WAVES}) s(step) LEFT JOIN found f ON f.step = s.step GROUP BY s.step"""


def stream_cursors(spark, sf_dir):
    """Cursors kept as a streaming aggregate over the same waves."""
    base = scratch(spark)
    waves = _waves(spark, sf_dir).select("folder", "uid", "wave")
    schema = waves.drop("wave").schema
    for wave in range(WAVES):
        waves.filter(F.col("wave") == wave).drop("wave").write.mode("append").parquet(f"{base}/in")
        cursor_stream(
            spark.readStream.schema(schema).parquet(f"{base}/in"),
            f"{base}/cursors", f"{base}/checkpoint", "s",
        ).awaitTermination()
    return read_cursor_steps(spark, f"{base}/cursors", WAVES)


def stream_limited(spark, sf_dir):
    """A stream of one file at a time, stopped and started again, loses no mail.

    Each file holds some of the UIDs of every folder, so that later files hold lower ones.
    """
    base = scratch(spark)
    mails = _enveloped(views.arrivals(spark, sf_dir))
    options = FetchOptions(folder="Events/*", recursive=True, incremental=True,
                           fetch_mode=HEADERS_ONLY, max_message_size=10000)
    for run in range(2):
        mails.filter(F.col("event_id") % 2 == run).repartition(
            3, F.floor(F.col("uid") / 50)
        ).write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(mails.schema).option("maxFilesPerTrigger", "1")
        incremental_stream(
            source.parquet(f"{base}/in"), f"{base}/out", f"{base}/cursors",
            f"{base}/checkpoint", options, unordered=True,
        ).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("relationship", "folder", "uid")


QUERIES = {
    "stream_limited": (
        stream_limited,
        f"WITH {ARRIVALS} SELECT CASE WHEN greatest(size, 0) <= 10000 THEN 'success' "
        "ELSE 'parse-error' END AS relationship, folder, uid FROM arrivals",
    ),
    "stream_incremental": (stream_incremental, _STREAM),
    "stream_counts": (stream_counts, _COUNTS),
    "stream_cursors": (
        stream_cursors,
        f"WITH {ARRIVALS} SELECT 's' AS state_folder, folder, max(uid) AS last_uid "
        "FROM arrivals GROUP BY folder",
    ),
}
