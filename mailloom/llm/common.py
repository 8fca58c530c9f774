"""What the operators on training text share: tables, folders, shipping, joins by row."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailloom.operators.joins import ensure_checkpoint_dir

#: Rows of an Arrow batch. A batch is held whole by a Python worker, and one
#: document can be some hundred times the usual length.
BATCH_ROWS = 500

#: Words are separated by ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_shipped: set[str] = set()

#: Folders that scratch() has named and nobody has removed.
_folders: list[str] = []


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, UTC, and the package on the Python path of executors."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    import mailloom

    package = os.path.dirname(os.path.abspath(mailloom.__file__))
    with tempfile.TemporaryDirectory(prefix="mailloom-") as folder:
        archive = shutil.make_archive(
            f"{folder}/mailloom-llm", "zip", os.path.dirname(package), os.path.basename(package)
        )
        with open(archive, "rb") as made:
            content = made.read()
    # Spark sends the file from here to the executors; it is code, not data.
    kept = os.path.join(tempfile.mkdtemp(prefix="mailloom-"), "mailloom-llm.zip")
    with open(kept, "wb") as out:
        out.write(content)
    sc.addPyFile(kept)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    _folders.append(f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}")
    return _folders[-1]


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
    """Write what ``make`` returns, and remove all that it wrote on its way.

    Returns the table as read again, and its folder.
    """
    before = len(_folders)
    result = make()
    used = _folders[before:]
    folder = scratch(spark)
    found = stored(result, folder)
    for done in used:
        remove(spark, done)
        _folders.remove(done)
    return found, folder


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there."""
    spark = df.sparkSession
    folder = folder or scratch(spark)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.parquet(folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that :func:`scratch` named, once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_key(text: str = "text") -> Column:
    """128 bits that stand for a text: rows with the same text have the same key."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def packed(documents: DataFrame) -> DataFrame:
    """All columns in one, ``doc``, so that none meets a name used on the way."""
    return documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc"))


def unpacked(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns that were packed, some of them replaced."""
    return df.select(*[
        (new[c] if c in new else F.col("doc").getField(c)).alias(c) for c in columns
    ])


def held_out() -> Column:
    """The fold that no label is learnt from: crc32 of the id's digits, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
