"""Joins of a big table to a table that is usually small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes a side may have to be broadcast, measured on its rows before the join.
BROADCAST_BYTES = 32 * 1024 * 1024

#: Copies of the lookup side when it is too big to broadcast and the keys of the big side
#: are not measured; the least number of shares the big side is thought cut into where
#: they are.
SALTS = 16


#: Rows of either side that meet in one cell of ``pairs_join``.
CELL_LEFT, CELL_RIGHT = 4096, 512

#: Bytes of pairs that a task of ``pairs_join`` gives.
PAIR_BYTES = 256 * 1024 * 1024

#: What a pair is thought to have besides the measured part of its left row.
PAIR_BASE = 512


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints that the session names in ``spark.checkpoint.dir``.

    Where none is named, a local session takes ``mailloom-checkpoints`` in its
    warehouse folder; a cluster has to name one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir')}/mailloom-checkpoints"
    sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df``, found by one aggregate over it."""
    size = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"a lookup table has plain columns only, not {field.name}")
    return df.agg(F.sum(size)).first()[0] or 0


def hot_keys(big: DataFrame, on: list[str], weight: Column) -> DataFrame:
    """``(*on, _cuts)``: keys with more than an even share of ``big``, and how many they have.

    A share is the weight of all rows divided by the shuffle partitions (``SALTS`` at
    least). No more keys than there are shares can hold more than one, so the result is
    small whatever ``big`` holds. A null key counts as a key.
    """
    shares = max(SALTS, int(big.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    per_key = materialise(big.groupBy(*on).agg(F.sum(weight).cast("double").alias("_weight")))
    total = per_key.agg(F.sum("_weight")).first()[0] or 0.0
    cuts = F.ceil(F.col("_weight") * shares / F.lit(max(total, 1.0))).cast("int")
    return per_key.select(*on, cuts.alias("_cuts")).filter("_cuts > 1")


def _cut(df: DataFrame, hot: DataFrame, on: list[str]) -> DataFrame:
    """``df`` with ``_cuts``, the number of tasks its key is spread over."""
    named = hot.withColumnsRenamed({key: f"_h_{key}" for key in on})
    same = F.lit(True)
    for key in on:
        same = same & F.col(key).eqNullSafe(F.col(f"_h_{key}"))
    return df.join(F.broadcast(named), same, "left").drop(*[f"_h_{key}" for key in on]).withColumn(
        "_cuts", F.coalesce("_cuts", F.lit(1))
    )


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    spread: list[str] | None = None,
    condition: Column | None = None,
    computed: bool = False,
    max_bytes: int = BROADCAST_BYTES,
    known_bytes: int | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """Join ``big`` to ``small`` on equal ``on`` columns, without a hot task.

    ``small`` is measured first. Up to ``max_bytes`` it is broadcast and ``big``
    does not move. Beyond that both sides are shuffled. ``spread`` names columns
    that tell apart the ``big`` rows of a key; with them the shuffle is on the
    key and a salt: a ``big`` row takes the salt of its ``spread`` columns, a
    ``small`` row is copied to every salt. It can be left out only where the key
    is unique in ``big``. All ways give the same rows.

    ``computed`` says that ``small`` is itself a query; it is then written once
    so that measuring and joining do not run it twice. ``condition`` is a
    further condition for rows of ``big``; a row that fails it finds nothing.
    ``known_bytes`` bounds the size of ``small`` where that has been measured before,
    or where ``small`` holds in arrays what has been measured as plain columns.

    With ``weight`` the salt follows the measured skew: the weight of ``big`` is summed per
    key, and only keys with more than an even share are cut, into as many parts as they have
    shares. Other keys are not copied. This reads the key, spread and weight columns of
    ``big`` once more, so it is for sides that a scan gives.
    """
    if computed:
        small = materialise(small)
    if (measured_bytes(small) if known_bytes is None else known_bytes) <= max_bytes:
        left, right, keys = big, F.broadcast(small), list(on)
    elif spread is None:
        left, right, keys = big, small, list(on)
    elif weight is not None:
        hot = hot_keys(big, on, weight)
        salt = F.pmod(F.xxhash64(*spread), F.col("_cuts")).cast("int")
        left = _cut(big, hot, on).withColumn("_salt", salt).drop("_cuts")
        right = _cut(small, hot, on).withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1))
        ).drop("_cuts")
        keys = [*on, "_salt"]
    else:
        salt = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
        left = big.withColumn("_salt", salt)
        right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        keys = [*on, "_salt"]

    names = {key: f"_r_{key}" for key in keys}
    right = right.withColumnsRenamed(names)
    match = F.lit(True) if condition is None else condition
    for key, renamed in names.items():
        match = match & (F.col(key) == F.col(renamed))
    joined = left.join(right, match, how)
    return joined.drop(*names.values(), "_salt")


def pairs_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_id: list[str],
    right_id: list[str],
    weight: Column | None = None,
) -> DataFrame:
    """All pairs of rows that agree in ``on``, where the pairs are far more than the rows.

    The rows of a key are dealt out by ``left_id`` and ``right_id`` to a grid of cells, a left
    row to all cells of its line and a right row to all of its column, so a left row is copied
    once per ``CELL_RIGHT`` pairs and a right row once per ``CELL_LEFT``. The number of tasks
    follows from the bytes of the pairs and not from those of the two sides; ``weight`` are the
    bytes of a left row that a pair repeats. The pairs of a left row come one after the other
    in a cell. Both sides are read three times, so they should be tables.
    """
    heavy = F.lit(PAIR_BASE).cast("double") + (F.lit(0) if weight is None else weight)
    lines = left.groupBy(*on).agg(
        F.sum(heavy).alias("_heavy"), F.ceil(F.count(F.lit(1)) / CELL_LEFT).alias("_lines")
    )
    rows = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    grid = materialise(lines.join(rows, on).select(
        *on, "_lines", F.ceil(F.col("_rows") / CELL_RIGHT).alias("_columns"),
        (F.col("_heavy") * F.col("_rows")).alias("_bytes"),
    ))
    tasks = int((grid.agg(F.sum("_bytes")).first()[0] or 0) // PAIR_BYTES) + 1
    grid, known = grid.drop("_bytes"), measured_bytes(grid.drop("_bytes"))

    def dealt(df: DataFrame, ids: list[str], own: str, other: str) -> DataFrame:
        met = lookup_join(df, grid, on, "inner", spread=ids, known_bytes=known)
        return met.select(
            *df.columns,
            F.pmod(F.xxhash64(*ids), F.col(f"_{own}s")).alias(f"_{own}"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_{other}s") - 1))
            .alias(f"_{other}"),
        )

    keys = [*on, "_line", "_column"]
    lefts = dealt(left, left_id, "line", "column").repartition(tasks, *keys)
    rights = dealt(right, right_id, "column", "line").repartition(tasks, *keys)
    return lefts.hint("merge").join(rights, keys).drop("_line", "_column")
