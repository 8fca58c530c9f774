from __future__ import annotations

import os
import shutil
import time
from datetime import datetime, timezone

import pyarrow as pa
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from mailloom import FetchOptions
from mailloom.operators.attachments import attachments
from mailloom.operators.folders import in_folder
from mailloom.plans.fetch import fetch
from mailloom.sources import landing
from mailloom.sources.ingest import _parse_batches, ingest, write_messages
from mailloom.sources.landing import (
    read_envelopes,
    read_messages,
    read_raw,
    stream_messages,
    stream_raw,
)
from mailloom.sources.sinks import read_route, write_routes
from suite import landing as landed
from tests.test_mime import FAULTY, INVOICE, NESTED, RAW, SIMPLE


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    for place, raw in {
        "INBOX/1.eml": SIMPLE, "INBOX/12.eml": INVOICE, "INBOX/sub dir/7.eml": NESTED,
        "Lists/o'x/3.eml": FAULTY, "Lists/draft.eml": SIMPLE, "INBOX/note.txt": b"not a mail",
        "INBOX/99.eml": b"Subject: long\n\n" + b"x" * 5000,
    }.items():
        path = root / place
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(raw)
    return str(root)


def keys(df):
    rows = df.select("folder", "uid").collect()
    return sorted(((r.folder, r.uid) for r in rows), key=lambda k: (k[0], k[1] or 0))


ALL = [("INBOX", 1), ("INBOX", 12), ("INBOX", 99), ("INBOX/sub dir", 7),
       ("Lists", None), ("Lists/o'x", 3)]


def test_folder_and_uid_come_from_the_path(spark, root):
    raw = read_raw(spark, root)
    assert keys(raw) == ALL
    assert keys(read_raw(spark, root + "/", "INBOX")) == ALL[:3]
    row = raw.filter("uid = 12").first()
    assert bytes(row.raw) == INVOICE and row.size == len(INVOICE)
    assert abs(row.received_ts.timestamp() - os.path.getmtime(root + "/INBOX/12.eml")) < 1


def test_size_filter_keeps_large_files_closed(spark, root):
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "2000")
    try:
        small = read_raw(spark, root).filter(F.col("size") <= 2000)
        assert len(small.collect()) == 5
        listed = read_raw(spark, root).select("folder", "uid", "size")
        assert listed.filter("size > 2000").count() == 1
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


@pytest.fixture(scope="module")
def table(spark, root, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table") / "messages")
    write_messages(ingest(read_raw(spark, root)), path, partitions=3)
    return path


def test_message_table(spark, table):
    mails = read_messages(spark, table)
    assert keys(mails) == ALL
    assert attachments(mails).count() == 6
    assert "content" not in read_envelopes(spark, table).columns
    assert keys(read_envelopes(spark, table)) == ALL


def test_envelope_queries_read_no_bodies(spark, table):
    mails = read_messages(spark, table)
    run = fetch(mails, FetchOptions(folder="INBOX", fetch_mode="HEADERS_ONLY"), capped=False)
    plan = run.success._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):].split("]")[0]
    assert "content#" not in scan and "parts#" not in scan and "headers#" not in scan
    assert keys(in_folder(mails, "INBOX*", True)) == ALL[:4]


def test_routes_on_disk(spark, table, tmp_path):
    options = FetchOptions(folder="*", recursive=True, include_attachments=True,
                           max_message_size=4000, max_attachment_size=3000)
    run = fetch(read_messages(spark, table), options, batch_id="b-1", capped=False)
    path = str(tmp_path / "routes")
    for _ in range(2):
        write_routes(run.tagged(), path)
    counts = dict(spark.read.parquet(path).groupBy("relationship").count().collect())
    assert counts == {"success": 5, "attachments": 6, "parse-error": 1}
    error = read_route(spark, path, "parse-error").first()
    assert error.attributes["error.message"] == "Message size 5015 exceeds limit 4000"
    files = read_route(spark, path, "attachments").filter("uid = 12").first()
    assert files.attributes["attachment.filename"] == "invoice.txt"
    assert bytes(files.content) == b"Total: 100\n"
    # The three outputs one by one hold the same rows.
    assert (run.success.count(), run.attachments.count(), run.parse_error.count()) == (5, 6, 1)


def test_streams_see_new_files(spark, tmp_path):
    root = tmp_path / "in"
    (root / "INBOX").mkdir(parents=True)
    (root / "INBOX" / "1.eml").write_bytes(SIMPLE)

    def land():
        query = (
            ingest(stream_raw(spark, str(root), max_files=10)).writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "c1")).option("path", str(tmp_path / "m"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()

    land()
    (root / "INBOX" / "2.eml").write_bytes(INVOICE)
    land()
    land()
    assert keys(read_messages(spark, str(tmp_path / "m"))) == [("INBOX", 1), ("INBOX", 2)]

    seen = []
    query = (
        stream_messages(spark, str(tmp_path / "m"), max_files=1).writeStream
        .foreachBatch(lambda df, step: seen.append((step, keys(df))))
        .option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(k for _, ks in seen for k in ks) == [("INBOX", 1), ("INBOX", 2)]


def test_large_files_are_not_opened(spark, tmp_path):
    (tmp_path / "INBOX").mkdir()
    (tmp_path / "INBOX" / "1.eml").write_bytes(SIMPLE)
    (tmp_path / "INBOX" / "2.eml").write_bytes(SIMPLE + b"x" * 5000)
    rows = ingest(read_raw(spark, str(tmp_path)), max_message_size=4000).collect()
    have = {r["uid"]: (r["message_id"], r["error_message"]) for r in rows}
    size = len(SIMPLE) + 5000
    assert have == {
        1: ("<tide-0307@harbour.example>", None),
        2: (None, f"Message size {size} exceeds limit 4000"),
    }


def test_a_table_grows_and_spreads_mails_without_uid(spark, tmp_path):
    raws = [("INBOX", None, None, len(SIMPLE), bytearray(SIMPLE.replace(b"0307", str(n).encode())))
            for n in range(200)]
    landed = ingest(spark.createDataFrame(raws, RAW))
    write_messages(landed, str(tmp_path / "m"), partitions=8)
    table = read_messages(spark, str(tmp_path / "m"))
    assert table.select(F.input_file_name()).distinct().count() > 4
    write_messages(landed.limit(5), str(tmp_path / "m"), mode="append")
    assert read_messages(spark, str(tmp_path / "m")).count() == 205


def test_files_follow_bytes(spark, tmp_path):
    # 8 tasks give one block of UIDs: 64 mails of 100 KB that do not compress, and small ones.
    large = F.col("id") % 64 == 0
    mails = spark.range(0, 4096, 1, 8).select(
        F.when(large, "large").otherwise("small").alias("folder"),
        F.col("id").alias("uid"), F.lit(None).cast("string").alias("message_id"),
        F.when(large, F.expr("unhex(replace(array_join(transform("
                             "sequence(1, 6250), i -> uuid()), ''), '-', ''))")).alias("content"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in
          (("msg_num", "long"), ("received_ts", "timestamp"), ("size", "long"),
           ("subject", "string"))],
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "1000000")
    try:
        write_messages(mails, str(tmp_path / "m"))
    finally:
        spark.conf.unset(name)
    files = sorted(f.stat().st_size for f in (tmp_path / "m").glob("*.parquet"))
    assert 4 <= len(files) <= 20 and max(files) < 2_500_000, files
    table = spark.read.parquet(str(tmp_path / "m"))
    assert table.count() == 4096 and "_block" not in table.columns


def test_files_by_time(spark, tmp_path):
    (tmp_path / "INBOX").mkdir()
    for uid, day in ((1, 1), (2, 2), (3, 3)):
        path = tmp_path / "INBOX" / f"{uid}.eml"
        path.write_bytes(SIMPLE)
        at = datetime(2024, 2, day, 12, tzinfo=timezone.utc).timestamp()
        os.utime(path, (at, at))
    root = str(tmp_path)
    after = read_raw(spark, root, modified_after="2024-02-01T13:00:00")
    between = read_raw(spark, root, "INBOX", "2024-02-01T13:00:00", "2024-02-02T13:00:00")
    assert keys(after) == [("INBOX", 2), ("INBOX", 3)]
    assert keys(between) == [("INBOX", 2)]


@pytest.mark.parametrize("how", ["archive", "delete"])
def test_a_landing_folder_is_kept_short(spark, tmp_path, how):
    root, away = tmp_path / "in", tmp_path / "away"
    (root / "INBOX").mkdir(parents=True)
    options = {"delete": True} if how == "delete" else {"archive": str(away)}

    def land(uid):
        (root / "INBOX" / f"{uid}.eml").write_bytes(SIMPLE)
        query = (
            ingest(stream_raw(spark, str(root), **options)).writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "m"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()

    land(1)
    land(2)
    until = time.time() + 20
    while (root / "INBOX" / "1.eml").exists() and time.time() < until:
        time.sleep(0.2)
    assert not (root / "INBOX" / "1.eml").exists()
    assert bool(list(away.rglob("1.eml"))) == (how == "archive")
    assert keys(read_messages(spark, str(tmp_path / "m"))) == [("INBOX", 1), ("INBOX", 2)]


def test_old_files_are_not_offered(spark, tmp_path):
    root = tmp_path / "in"
    (root / "INBOX").mkdir(parents=True)

    def land(uid, days):
        path = root / "INBOX" / f"{uid}.eml"
        path.write_bytes(SIMPLE)
        os.utime(path, (time.time() - days * 86400,) * 2)

    seen = []
    # Files of the first batch set the time that later ones are held against.
    for uid, days in ((1, 0), (2, 30), (3, 1)):
        land(uid, days)
        query = (
            stream_raw(spark, str(root), max_age="7d").writeStream
            .foreachBatch(lambda df, step: seen.extend(keys(df)))
            .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    assert seen == [("INBOX", 1), ("INBOX", 3)]
    with pytest.raises(ValueError):
        stream_raw(spark, str(root), archive="/x", delete=True)


def test_routes_are_written_without_a_sort(spark, table, tmp_path):
    run = fetch(read_messages(spark, table), FetchOptions(folder="*", recursive=True),
                batch_id="b-1", capped=False)
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen = spark.conf.get(name), []

    class Tagged:
        """Rows that note the setting under which they are written."""

        sparkSession, rows = spark, run.tagged()

        @property
        def write(self):
            seen.append(int(spark.conf.get(name)))
            return self.rows.write

    write_routes(Tagged(), str(tmp_path / "routes"))
    assert seen[0] >= 3 and spark.conf.get(name) == before


@pytest.fixture(scope="module")
def small_mails(tmp_path_factory):
    """Four hundred files, which a scan cuts into thirteen splits."""
    root = tmp_path_factory.mktemp("small")
    (root / "INBOX").mkdir()
    for uid in range(1, 401):
        (root / "INBOX" / f"{uid}.eml").write_bytes(SIMPLE)
    return str(root)


def test_small_files_are_read_by_few_tasks(spark, small_mails, monkeypatch):
    raw = read_raw(spark, small_mails)
    cores = 2 * spark.sparkContext.defaultParallelism
    assert raw.rdd.getNumPartitions() == cores < 13
    assert sorted(r.uid for r in raw.select("uid").collect()) == list(range(1, 401))
    # Large mails keep the splits of the scan.
    monkeypatch.setattr(landing, "TASK_BYTES", 1)
    assert read_raw(spark, small_mails).rdd.getNumPartitions() == 13


def test_a_bounded_stream_takes_all_files_in_batches_of_few_tasks(spark, small_mails, tmp_path):
    seen = []

    def handle(batch, number):
        seen.append((batch.rdd.getNumPartitions(), [r.uid for r in batch.select("uid").collect()]))

    raw = stream_raw(spark, small_mails, max_files=390)
    raw.writeStream.foreachBatch(handle).option(
        "checkpointLocation", str(tmp_path / "c")
    ).trigger(availableNow=True).start().awaitTermination()
    assert [len(uids) for _, uids in seen] == [390, 10]
    assert sorted(uid for _, uids in seen for uid in uids) == list(range(1, 401))
    assert max(tasks for tasks, _ in seen) <= 2 * spark.sparkContext.defaultParallelism


def test_the_landed_stream_has_bounded_batches(spark, monkeypatch):
    given = []

    def stop(*args, **options):
        given.append(options)
        raise InterruptedError

    monkeypatch.setattr(landed, "stream_raw", stop)
    monkeypatch.setattr(landed, "land", lambda raw, root: None)
    monkeypatch.setattr(landed.views, "mixed_raw", lambda spark, sf_dir: spark.range(1).select(
        F.col("id").alias("uid")))
    with pytest.raises(InterruptedError):
        landed.landed_stream(spark, "")
    assert 0 < given[0]["max_files"] <= 100_000


def test_parsed_mails_are_handed_on_in_small_batches():
    count, mail = 12, SIMPLE + b"x" * 2**20
    batch = pa.RecordBatch.from_pydict({
        "folder": ["INBOX"] * count, "uid": list(range(count)),
        "msg_num": pa.nulls(count, pa.int64()),
        "received_ts": pa.nulls(count, pa.timestamp("us", tz="UTC")),
        "size": [len(mail)] * count, "flags": pa.nulls(count, pa.list_(pa.string())),
        "raw": [mail] * count,
    })
    given = [found["uid"].to_pylist() for found in _parse_batches(iter([batch]), True)]
    assert sum(given, []) == list(range(count)) and max(map(len, given)) <= 4


def taken(raw, place):
    """What a stream of mails offers when it is started: the rows of each batch."""
    seen = []
    raw.writeStream.foreachBatch(lambda df, step: seen.append(df.collect())).option(
        "checkpointLocation", str(place)
    ).trigger(availableNow=True).start().awaitTermination()
    return seen


def test_a_stream_with_a_log_gives_the_rows_of_spark_s_listing(spark, root, tmp_path):
    for place in ("INBOX/.hidden.eml", "_left/5.eml", "INBOX/6.eml._COPYING_"):
        path = tmp_path / "in" / place
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(SIMPLE)
    shutil.copytree(root, tmp_path / "in", dirs_exist_ok=True)
    (tmp_path / "in" / "k=1 é%20" / "x.eml").mkdir(parents=True)
    (tmp_path / "in" / "k=1 é%20" / "x.eml" / "8.eml").write_bytes(NESTED)
    (tmp_path / "in" / "5.eml").write_bytes(INVOICE)
    at = str(tmp_path / "in")
    plain = taken(stream_raw(spark, at), tmp_path / "c1")
    logged = taken(stream_raw(spark, f"file://{at}/", log=str(tmp_path / "log")), tmp_path / "c2")
    assert sorted(map(str, sum(logged, []))) == sorted(map(str, sum(plain, [])))
    assert len(sum(logged, [])) == len(ALL) + 2


def test_a_stream_with_a_log_takes_each_file_once_in_bounded_batches(spark, tmp_path, monkeypatch):
    def start(uids):
        for uid in uids:
            (tmp_path / "in" / f"{uid}.eml").write_bytes(SIMPLE)
        raw = stream_raw(spark, str(tmp_path / "in"), max_files=40, log=str(tmp_path / "log"))
        return [[r.uid for r in batch] for batch in taken(raw, tmp_path / "c")]

    monkeypatch.setattr(landing, "LOG_SHARES", 4)
    (tmp_path / "in").mkdir()
    assert sum(start([]), []) == []
    batches = start(range(100))
    assert sorted(sum(batches, [])) == list(range(100))
    assert 3 <= len(batches) and max(map(len, batches)) <= 40
    assert start([]) == []
    # A stream that was not started after its files were found has them from the next start.
    (tmp_path / "in" / "100.eml").write_bytes(SIMPLE)
    stream_raw(spark, str(tmp_path / "in"), max_files=40, log=str(tmp_path / "log"))
    assert sorted(sum(start(range(101, 107)), [])) == list(range(100, 107))
    # A stream that is started anew has all files of the log; one that is gone is left out.
    (tmp_path / "in" / "3.eml").unlink()
    raw = stream_raw(spark, str(tmp_path / "in"), log=str(tmp_path / "log"))
    seen = sum(taken(raw, tmp_path / "other"), [])
    assert sorted(r.uid for r in seen) == [uid for uid in range(107) if uid != 3]


def test_a_stream_with_a_log_leaves_out_old_files(spark, tmp_path):
    def start(uid, days):
        path = tmp_path / "in" / f"{uid}.eml"
        path.write_bytes(SIMPLE)
        os.utime(path, (time.time() - days * 86400,) * 2)
        raw = stream_raw(spark, str(tmp_path / "in"), max_age="7d", log=str(tmp_path / "log"))
        return [r.uid for batch in taken(raw, tmp_path / "c") for r in batch]

    (tmp_path / "in").mkdir()
    assert [start(1, 0), start(2, 30), start(3, 1)] == [[1], [], [3]]
    for cleaned in ({"delete": True}, {"archive": "/x"}):
        with pytest.raises(ValueError):
            stream_raw(spark, str(tmp_path / "in"), log=str(tmp_path / "log"), **cleaned)


def test_the_landed_stream_keeps_no_mail_files_on_the_driver(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landed, "scratch", lambda spark: str(tmp_path))
    mails = spark.range(300).select(
        F.lit("INBOX").alias("folder"), F.col("id").alias("uid"), F.lit(SIMPLE).alias("raw"))
    monkeypatch.setattr(landed.views, "mixed_raw", lambda spark, sf_dir: mails)
    found = landed.landed_stream(spark, "").select("folder", "uid").collect()
    assert sorted(found) == [("INBOX", uid) for uid in range(300)]
    # What the source writes is what it keeps: Spark's own listing has all paths there.
    kept = [p.read_text() for p in (tmp_path / "checkpoint" / "sources" / "0").glob("[0-9]*")]
    assert len(kept) >= 2 and sum(text.count('"path"') for text in kept) < 50
    assert ".eml" not in "".join(kept)


def test_folders_and_mails_are_the_same_through_pyarrow(root, monkeypatch):
    def found(below):
        batch = pa.RecordBatch.from_pydict({"folder": [below]})
        return sum((b.to_pylist() for b in landing._lister(f"file:{root}")(iter([batch]))), [])

    def mails(rows):
        batch = pa.RecordBatch.from_pylist([r for r in rows if r["path"]])
        return sum((b.to_pylist() for b in landing._reader(f"file:{root}")(iter([batch]))), [])

    local = [found(below) for below in ("", "/INBOX", "/gone")]
    content = mails(local[1])
    assert [len(rows) for rows in local] == [2, 4, 0] and len(content) == 3
    assert {r["path"]: r["content"] for r in content}[f"file:{root}/INBOX/12.eml"] == INVOICE
    monkeypatch.setattr(landing, "_opened", lambda uri: (fs.LocalFileSystem(), uri[5:]))
    for below, rows in zip(("", "/INBOX", "/gone"), local, strict=True):
        assert sorted(found(below), key=str) == sorted(rows, key=str)
    assert mails(local[1]) == content


def test_names_that_spark_leaves_out():
    for name in ("7.eml", "_x=1", "_metadata", "é.eml"):
        assert not landing._hidden(name)
    for name in (".7.eml", "_x", "7.eml._COPYING_", "\udce9.eml"):
        assert landing._hidden(name)
