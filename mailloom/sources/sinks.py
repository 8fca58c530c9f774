"""Writing the outputs of a run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailloom.operators.cursor import advance_cursor
from mailloom.operators.joins import lookup_join
from mailloom.operators.summary import run_summary
from mailloom.schema import CURSOR, ID_SET, MARK, OUTPUTS, PARSE_ERROR, SUCCESS

#: Steps between two full copies of cursors, marks and delivered UIDs.
SNAPSHOT_EVERY = 100


def write_routes(tagged: DataFrame, path: str) -> None:
    """Write tagged rows, one folder per output. Writing again replaces them.

    A task keeps a file open for each output it meets, and so does not sort its rows, bodies
    included, by output.
    """
    spark, files = tagged.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(files)
    spark.conf.set(files, str(len(OUTPUTS)))
    try:
        tagged.write.mode("overwrite").partitionBy("relationship").parquet(path)
    finally:
        spark.conf.set(files, before)


def read_route(spark: SparkSession, path: str, relationship: str) -> DataFrame:
    """Rows of one output; the others are not opened."""
    return spark.read.parquet(path).filter(F.col("relationship") == relationship)


def _block() -> Column:
    """The run of 32,768 UIDs that a UID is in; none for messages without a real UID."""
    return F.when(F.col("uid") > 0, F.bitmap_bucket_number("uid"))


def _merged_ids(sets: DataFrame) -> DataFrame:
    return sets.groupBy("folder", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def write_delivered_step(keys: DataFrame, path: str, step: int) -> None:
    """Log the UIDs that a step has in its outputs, a bit each. Writing again replaces it."""
    sets = keys.filter(F.col("uid") > 0).groupBy("folder", _block().alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("uid")).alias("bits")
    )
    _write_log(sets, _delivered_path(path), step, ID_SET, _merged_ids)


def not_delivered(messages: DataFrame, path: str, step: int) -> DataFrame:
    """Messages whose UIDs no step before ``step`` has in its outputs.

    The log below ``path`` says so; outputs are not read. Of its sets only those of the
    batch's folders and blocks of UIDs are joined. A message without a UID is always new.
    """
    if step <= 0:
        return messages
    sets = _read_log(messages.sparkSession, _delivered_path(path), step, ID_SET)
    touched = messages.filter(F.col("uid") > 0).select("folder", _block().alias("block")).distinct()
    seen = _merged_ids(sets.join(touched, ["folder", "block"], "left_semi"))
    place = F.bitmap_bit_position("uid")
    byte = F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    bit = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(
        F.expr("shiftleft(1, cast(bitmap_bit_position(uid) % 8 as int))")
    )
    return lookup_join(
        messages.withColumn("_block", _block()),
        seen.withColumnsRenamed({"block": "_block", "bits": "_bits"}),
        ["folder", "_block"], spread=["uid"], computed=True,
    ).filter(F.col("_bits").isNull() | (bit == 0)).drop("_block", "_bits")


def write_cursor_step(cursors: DataFrame, known: DataFrame, path: str, step: int) -> None:
    """Write the cursors reached by a step. Writing the step again replaces it.

    ``known`` are the cursors before the step. Every ``SNAPSHOT_EVERY`` steps
    they are written along, so that reading never goes further back than that.
    """
    columns = CURSOR.fieldNames()
    rows = cursors.select(*columns)
    if step % SNAPSHOT_EVERY == 0:
        rows = advance_cursor(known.select(*columns), rows)
    rows.write.mode("overwrite").parquet(_step_path(path, step))


def read_cursor_steps(spark: SparkSession, path: str, before: int) -> DataFrame:
    """Cursors as of a step: the highest value any earlier step reached.

    Steps are numbered from 0 without gaps.
    """
    if before <= 0:
        return spark.createDataFrame([], CURSOR)
    first = (before - 1) // SNAPSHOT_EVERY * SNAPSHOT_EVERY
    files = spark.read.schema(CURSOR).parquet(
        *[_step_path(path, step) for step in range(first, before)]
    )
    return files.groupBy("state_folder", "folder").agg(F.max("last_uid").alias("last_uid"))


def delivered_keys(spark: SparkSession, path: str) -> DataFrame:
    """Folder and UID of the messages an output has, from what was written."""
    return (
        spark.read.schema("folder string, uid bigint, relationship string").parquet(path)
        .filter((F.col("relationship") == SUCCESS) & (F.col("uid") > 0))
        .select("folder", "uid")
    )


def step_counts(spark: SparkSession, path: str) -> DataFrame:
    """Messages per folder and in total that a step has in its outputs, as ``run_summary`` has them.

    They are counted from the rows that were written, a failed message once and
    attachments not at all. For a step without a cap these are all its candidates.
    """
    rows = spark.read.schema("folder string, relationship string").parquet(path)
    return run_summary(rows.filter(F.col("relationship").isin(SUCCESS, PARSE_ERROR)))


def write_mark_step(
    delivered: DataFrame, path: str, step: int, read: Column | bool, deleted: Column | bool
) -> None:
    """Log what a step marks. Writing the step again replaces it; no message is rewritten.

    ``read`` and ``deleted`` are values or Columns of ``delivered``.
    """
    marks = delivered.select(
        "folder", "uid", *[
            (value if isinstance(value, Column) else F.lit(value)).alias(name)
            for name, value in (("read", read), ("deleted", deleted))
        ],
    )
    _write_log(marks.distinct(), _marks_path(path), step, MARK, _merged_marks)


def read_mark_steps(spark: SparkSession, path: str, before: int) -> DataFrame:
    """Marks of all steps before ``before``; steps without marks are passed over."""
    return _read_log(spark, _marks_path(path), before, MARK)


def _merged_marks(marks: DataFrame) -> DataFrame:
    """One row per message, in the order of folders and UIDs so that readers skip blocks."""
    return marks.groupBy("folder", "uid").agg(
        F.max("read").alias("read"), F.max("deleted").alias("deleted")
    ).repartitionByRange("folder", "uid").sortWithinPartitions("folder", "uid")


def _write_log(
    rows: DataFrame, path: str, step: int, schema: T.StructType,
    merged: Callable[[DataFrame], DataFrame],
) -> None:
    """Write a step of a log. Writing the latest step again replaces it.

    The first step that writes in a run of ``SNAPSHOT_EVERY`` steps writes what all steps
    before that run come to, once, as the base that later readers start from.
    """
    spark, era = rows.sparkSession, step // SNAPSHOT_EVERY
    if era and not _exists(spark, f"{_base_path(path, era)}/_SUCCESS"):
        before = _read_log(spark, path, era * SNAPSHOT_EVERY, schema)
        merged(before).write.mode("overwrite").parquet(_base_path(path, era))
    rows.write.mode("overwrite").parquet(_step_path(_era_path(path, era), step))


def _read_log(spark: SparkSession, path: str, before: int, schema: T.StructType) -> DataFrame:
    """Rows of a log before a step: one base, and the steps since."""
    found, last = spark.createDataFrame([], schema), (before - 1) // SNAPSHOT_EVERY
    first = next(
        (era for era in range(last, 0, -1) if _exists(spark, f"{_base_path(path, era)}/_SUCCESS")), 0
    )
    if first:
        found = spark.read.schema(schema).parquet(_base_path(path, first))
    stepped = T.StructType([*schema.fields, T.StructField("step", T.IntegerType())])
    for era in range(first, last + 1):
        if _exists(spark, _era_path(path, era)):
            steps = spark.read.schema(stepped).parquet(_era_path(path, era))
            found = found.unionByName(steps.filter(F.col("step") < before).drop("step"))
    return found


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _marks_path(path: str) -> str:
    return f"{path.rstrip('/')}/marks"


def _delivered_path(path: str) -> str:
    return f"{path.rstrip('/')}/delivered"


def _base_path(path: str, era: int) -> str:
    return f"{path}/base/era={era}"


def _era_path(path: str, era: int) -> str:
    return f"{path}/steps/era={era}"


def _step_path(path: str, step: int) -> str:
    return f"{path.rstrip('/')}/step={step}"
