"""Landed mail: files ``<folder>/<uid>.eml`` below a root, or message tables."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamReader

from mailloom.operators.joins import ensure_checkpoint_dir
from mailloom.schema import MESSAGE
from mailloom.sources.ingest import BATCH_BYTES, BATCH_ROWS

#: What the binary file source gives; a stream has to name it.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"

#: Bytes of mails, and splits of a file scan, that one task reads.
TASK_BYTES = 32 * 1024 * 1024
TASK_SPLITS = 32

#: Mails that one file of a stream's log names, at most, and files of it in a bounded batch.
LOG_ROWS = 2000
LOG_SHARES = 50

#: A stream's log: the mails that were found, each once.
_LOGGED = "path string, modificationTime timestamp, length bigint"
_LOG_FIELDS = [
    ("path", pa.string()),
    ("modificationTime", pa.timestamp("us", tz="UTC")),
    ("length", pa.int64()),
]

#: Columns a listing of envelopes needs; bodies and parts stay on disk.
ENVELOPE_COLUMNS = [
    name for name in MESSAGE.fieldNames() if name not in ("content", "parts", "headers")
]


def _raw_columns(files: DataFrame, root: str) -> DataFrame:
    root = re.sub("^file:/+", "/", root).rstrip("/") + "/"
    path = F.col("path")
    below = F.substr(path, F.instr(path, root) + len(root))
    name = F.regexp_extract(below, r"([^/]*)$", 1)
    return files.select(
        F.regexp_replace(below, r"/?[^/]*$", "").alias("folder"),
        F.regexp_extract(name, r"^([0-9]+)\.eml$", 1).try_cast("bigint").alias("uid"),
        F.col("modificationTime").alias("received_ts"),
        F.col("length").alias("size"),
        F.col("content").alias("raw"),
    )


def _few_tasks(files: DataFrame) -> DataFrame:
    """``files`` in tasks of about ``TASK_BYTES`` and at most ``TASK_SPLITS`` splits of the scan.

    A scan counts each file as ``spark.sql.files.openCostInBytes`` more, so a split of it has
    32 mails, and a folder of millions of mails as many tasks as mails a small one has. Splits
    are put together and not shuffled; each core keeps two tasks, if there are as many splits.
    Nothing runs for it: sizes and splits are known from the listing.
    """
    plan = files._jdf.queryExecution()
    splits = plan.toRdd().getNumPartitions()
    held = int(str(plan.optimizedPlan().stats().sizeInBytes()))
    cores = 2 * files.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-held // TASK_BYTES), -(-splits // TASK_SPLITS), cores)
    return files.coalesce(tasks) if tasks < splits else files


def _as_it_is(folder: str) -> str:
    """A folder name in which no character stands for others."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", folder)


def read_raw(
    spark: SparkSession,
    root: str,
    folder: str | None = None,
    modified_after: str | None = None,
    modified_before: str | None = None,
) -> DataFrame:
    """All mails below ``root``, or those of one folder without opening others.

    ``root`` is an absolute path or a URI. The folder is the directory below
    the root, the UID the number in the file name, the received time the
    file's. A filter on ``size`` reaches the file scan: files it rules out are
    not opened, and neither is any file when ``raw`` is not selected.
    ``modified_after`` and ``modified_before`` (``2024-02-01T00:00:00``, in the session's time
    zone) leave out files by their time when they are listed. From
    ``spark.sql.sources.parallelPartitionDiscovery.threshold`` folders on, Spark lists them
    on the executors.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.eml")
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    if modified_before is not None:
        reader = reader.option("modifiedBefore", modified_before)
    if folder is None:
        files = reader.option("recursiveFileLookup", "true").load(root)
    else:
        files = reader.load(f"{root.rstrip('/')}/{_as_it_is(folder)}")
    return _raw_columns(_few_tasks(files), root)


def _source_options(
    reader: DataStreamReader,
    max_files: int | None,
    max_age: str | None,
    archive: str | None,
    delete: bool,
) -> DataStreamReader:
    if archive is not None and delete:
        raise ValueError("files are archived or deleted, not both")
    options = {
        "maxFilesPerTrigger": None if max_files is None else str(max_files),
        "maxFileAge": max_age,
        "cleanSource": "archive" if archive is not None else "delete" if delete else None,
        "sourceArchiveDir": archive,
    }
    return reader.options(**{name: value for name, value in options.items() if value is not None})


def _qualified(spark: SparkSession, path: str):
    """A path as Hadoop names it in full, and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(place), files


def _opened(uri: str) -> tuple[fs.FileSystem | None, str]:
    """The file system of a URI and the path in it; no file system where it is local."""
    if uri.startswith("file:"):
        return None, re.sub("^file:/+", "/", uri)
    return fs.FileSystem.from_uri(quote(re.sub("^s3[an]:", "s3:", uri), safe=":/@"))


def _entries(uri: str, folder: str) -> Iterator[tuple[str, bool, int, int]]:
    """What is in a folder: name, whether it is one, time in ms and length."""
    files, place = _opened(uri + folder)
    if files is None:
        with os.scandir(place) as found:
            for entry in found:
                try:
                    stat = entry.stat()
                    yield entry.name, entry.is_dir(), stat.st_mtime_ns // 10**6, stat.st_size
                except FileNotFoundError:  # taken away while the folder is listed
                    continue
    else:
        for info in files.get_file_info(fs.FileSelector(place)):
            is_folder = info.type == fs.FileType.Directory
            yield info.base_name, is_folder, (info.mtime_ns or 0) // 10**6, info.size or 0


def _hidden(name: str) -> bool:
    """Names that Spark's listing leaves out: hidden, half copied or no UTF-8."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return (
        name.startswith(".") or (name.startswith("_") and "=" not in name)
        or name.endswith("._COPYING_")
        or (not name.isascii() and any("\ud800" <= c <= "\udfff" for c in name))
    )


def _lister(uri: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lists folders below ``uri``: one row for each folder and each mail file in them."""
    schema = pa.schema([*_LOG_FIELDS, ("folder", pa.string())])

    def rows(below: str) -> Iterator[tuple]:
        try:
            for name, folder, ms, length in _entries(uri, below):
                if _hidden(name) or not (folder or name.endswith(".eml")):
                    continue
                path = f"{below}/{name}"
                yield (None, None, None, path) if folder else (uri + path, ms * 1000, length, None)
        except FileNotFoundError:  # a folder that is gone; the root has to be there
            if not below:
                raise

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        for batch in batches:
            for below in batch.column(0).to_pylist():
                for row in rows(below):
                    done.append(row)
                    if len(done) >= BATCH_ROWS:
                        full, done = _batch(done, schema), []
                        yield full
        if done:
            yield _batch(done, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _listed(spark: SparkSession, uri: str, work: str) -> DataFrame:
    """All mail files below ``uri`` as rows of a log, by tasks that list a folder each."""
    tasks = 2 * spark.sparkContext.defaultParallelism
    folders, levels = spark.createDataFrame([("",)], "folder string"), []
    while not levels or not folders.isEmpty():
        levels.append(f"{work}/level-{len(levels)}")
        found = folders.repartition(tasks).mapInArrow(_lister(uri), f"{_LOGGED}, folder string")
        found.write.parquet(levels[-1])
        folders = spark.read.parquet(levels[-1]).select("folder").filter("folder IS NOT NULL")
    return spark.read.parquet(*levels).filter("folder IS NULL").drop("folder")


def _log_new(
    spark: SparkSession, root: str, log: str, max_files: int | None, max_age: str | None
) -> None:
    """Add the mail files below ``root`` that a log does not name yet to it."""
    work = f"{ensure_checkpoint_dir(spark)}/listing-{uuid.uuid4().hex}"
    place, files = _qualified(spark, work)
    try:
        new = _listed(spark, _qualified(spark, root)[0].toString(), work)
        at, logs = _qualified(spark, log)
        begun = logs.exists(at)
        if begun:
            known = spark.read.schema(_LOGGED).parquet(log)
            if max_age is not None:
                age = spark._jvm.org.apache.spark.network.util.JavaUtils.timeStringAsMs(max_age)
                time = F.unix_millis("modificationTime")
                newest = known.agg(F.max(time)).first()[0]
                if newest is not None:
                    new = new.filter(time >= newest - age)
            # Names of millions of files are small in Parquet and large when broadcast.
            new = new.join(known.select("path").hint("merge"), "path", "left_anti")
        new.select("path", "modificationTime", "length").write.parquet(f"{work}/new")
        new = spark.read.schema(_LOGGED).parquet(f"{work}/new")
        count = new.count()
        if count or not begun:
            # Enough files for all cores, but no more than a scan would cut into splits.
            tasks = 2 * spark.sparkContext.defaultParallelism
            spread = new.repartition(max(1, min(tasks, -(-count // TASK_SPLITS))))
            spread.write.option("maxRecordsPerFile", str(_log_rows(max_files))).mode(
                "append").parquet(log)
    finally:
        files.delete(place, True)


def _log_rows(max_files: int | None) -> int:
    """Mails that a file of a log names, at most; a batch of ``max_files`` has several files."""
    return LOG_ROWS if max_files is None else max(1, min(LOG_ROWS, max_files // LOG_SHARES))


def _reader(uri: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the bytes of the files below ``uri`` to rows of a log."""
    schema = pa.schema([*_LOG_FIELDS, ("content", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _opened(uri)
        done: list[tuple] = []
        held = 0
        for batch in batches:
            for row in batch.to_pylist():
                at = base + row["path"][len(uri):]
                try:
                    with open(at, "rb") if files is None else files.open_input_stream(at) as mail:
                        content = mail.read()
                except FileNotFoundError:
                    continue
                done.append((row["path"], row["modificationTime"], row["length"], content))
                held += len(content)
                if held >= BATCH_BYTES or len(done) >= BATCH_ROWS:
                    full, done, held = _batch(done, schema), [], 0
                    yield full
                    del full
        if done:
            yield _batch(done, schema)

    return run


def _logged_files(spark: SparkSession, root: str, log: str, max_files: int | None) -> DataFrame:
    """What the binary file source gives, for the files that a log names."""
    # A file of the log that no batch has taken yet must not become too old for Spark.
    reader = spark.readStream.schema(_LOGGED).option("maxFileAge", "36500d")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files // _log_rows(max_files)))
    uri = _qualified(spark, root)[0].toString()
    return reader.parquet(log).mapInArrow(_reader(uri), _FILES)


def stream_raw(
    spark: SparkSession,
    root: str,
    max_files: int | None = None,
    max_age: str | None = None,
    archive: str | None = None,
    delete: bool = False,
    log: str | None = None,
) -> DataFrame:
    """The same rows as a stream: each trigger sees the files that are new.

    A long-running landing folder is kept short in two ways. Files older than ``max_age``
    (``7d``, against the newest file seen) are not offered, and the stream may forget them.
    ``archive`` names a folder outside ``root`` that files are moved to once their batch is
    done, or ``delete`` removes them; each trigger then lists only what is still there.
    The files of a batch are cleaned when a later batch starts.

    ``max_files`` are the most files of a micro-batch. Spark lists the files of a batch by a
    job that sends a few KB of each to the driver, all at once, so a folder that can hold a
    million new files should have such a bound (``availableNow`` still takes all of them, in
    several batches). Such a batch is read by two tasks for each core, not by one for 32 mails.

    Spark's listing keeps all files of the folder on the driver, whatever the bound is (600,000
    do not fit a heap of 750 MB). With ``log``, a folder outside ``root`` that belongs to this
    stream as its checkpoint does, the driver keeps nothing per file: tasks list ``root``, what
    the log does not name yet is added to it, and the stream reads the log and opens the files
    in its tasks.
    ``root`` is listed when this function is called, so a stream that runs on takes new files
    from the next call, by any process, one at a time. Without ``max_age`` no file is too old.
    ``root`` is no pattern, and local or of a kind that pyarrow opens; files in the log are not
    archived or deleted. A file that is gone when it is to be read is left out.
    """
    if log is not None:
        if archive is not None or delete:
            raise ValueError("files of a stream with a log are not archived or deleted")
        _log_new(spark, root, log, max_files, max_age)
        return _raw_columns(_logged_files(spark, root, log, max_files), root)
    reader = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("pathGlobFilter", "*.eml")
        .option("recursiveFileLookup", "true")
    )
    files = _source_options(reader, max_files, max_age, archive, delete).load(root)
    if max_files is not None:
        files = files.coalesce(2 * spark.sparkContext.defaultParallelism)
    return _raw_columns(files, root)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """A message table written by ``write_messages``."""
    return spark.read.schema(MESSAGE).parquet(path)


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Envelope, flags and UID of a message table, without any body."""
    return read_messages(spark, path).select(*ENVELOPE_COLUMNS)


def stream_messages(
    spark: SparkSession, path: str, max_files: int | None = None, max_age: str | None = None
) -> DataFrame:
    """A message table as a stream of the files that are added to it.

    With ``max_files`` the files come in several micro-batches, in no order of UIDs.
    ``max_age`` is as in ``stream_raw``; the files are a table and stay.
    """
    reader = _source_options(spark.readStream.schema(MESSAGE), max_files, max_age, None, False)
    return reader.parquet(path)
