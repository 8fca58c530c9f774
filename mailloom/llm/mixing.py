"""Mix sources to target weights by Pareto order sampling.

A source's target is its share of all words, at most ``max_copies`` times what it
has. With r = target / size of the source, every document is taken floor(r) times
for certain, and the rest f = r - floor(r) by order sampling: each document draws a
random number u from a hash of its id and text, and the documents of a source are
ranked by the odds of u divided by the odds of their inclusion. The first ones in
this order are taken until the words that are left to take are reached (the sample's
size is fixed in words; the document at the cut is taken if that is nearer).
``preference`` names a column that multiplies the inclusion odds of a document.

No source is sorted in one task: the ranks are cut into bins, the bin where the cut
falls is found from sums per source and bin, and only that bin is sorted.

Nulls, ties and odd rows: a null text or one without words has size 0; a null source
is a source of its own, sorted last; a null id draws by its text alone; rows that
agree in id and text draw the same number, so that which of them is taken does not
matter. A null, negative or zero preference counts as 1. An empty table gives no
rows. Other columns are passed over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailloom.llm.common import WORD, stored

#: Bins a source's ranks are cut into, and bins that are looked at together first.
BINS, GROUP = 65536, 256


def allocate(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), max_copies: int = 3):
    """Targets of ``(source, source_size)`` rows: shares by weight, capped, excess reshared.

    Sources that meet their cap are those with the least size per weight, so one pass
    over the sources in that order finds which are capped and what the others share.
    One row per source meets in one task here.
    """
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(w).cast("long") for w in cycle])
    weighed = sizes.withColumn("weight", F.element_at(weights, (n % len(cycle) + 1).cast("int")))
    by_cap = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranked = weighed.select(
        "source", "source_size", "weight",
        F.sum("source_size").over(whole).alias("total"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("_capped"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .alias("_open"),
        F.row_number().over(by_cap).alias("_place"),
    )
    # The level if all sources before this one are capped; the first source that
    # stays below its cap at its level sets the level of all that are not capped.
    level = (F.col("total") - max_copies * F.col("_capped")) / F.col("_open")
    fits = level * F.col("weight") <= max_copies * F.col("source_size")
    first = F.min(F.when(fits, F.struct("_place", level.alias("level")))).over(whole)
    leveled = ranked.withColumn("_first", first)
    share = F.col("_first.level") * F.col("weight")
    cap = (max_copies * F.col("source_size")).cast("double")
    return leveled.select(
        "source", "source_size", F.coalesce(F.least(cap, share), cap).alias("target")
    )


def mix(
    documents: DataFrame,
    cycle: tuple[int, ...] = (1, 2, 3),
    max_copies: int = 3,
    seed: int = 1,
    preference: str | None = None,
) -> DataFrame:
    """One row per document with how often the mix takes it (``copies``, may be 0)."""
    drawn = F.conv(F.substring(F.md5(F.concat_ws(
        ":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.md5(F.coalesce("text", F.lit(""))),
    )), 1, 13), 16, 10).cast("double")
    liked = F.lit(1.0) if preference is None else F.col(preference).cast("double")
    small = stored(documents.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ((drawn + 0.5) / F.lit(2.0**52)).alias("u"),
        F.when(liked > 0, liked).otherwise(1.0).alias("liked"),
    ))
    targets = allocate(
        small.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, max_copies
    )
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("sure", F.floor(ratio)).withColumn(
        "part", ratio - F.col("sure")
    ).withColumn("rest", F.col("target") - F.col("sure") * F.col("source_size"))
    targets = stored(targets)

    odds = F.col("u") / (1 - F.col("u"))
    inclusion = F.col("part") / (1 - F.col("part")) * F.col("liked")
    ranked = _with_source(small, targets).withColumn(
        "rank", F.when(F.col("part") > 0, odds / inclusion)
    ).withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS))

    bins = ranked.where("part > 0").groupBy("source", "bin").agg(
        F.sum("size").alias("words"), F.first("rest").alias("rest")
    ).withColumn("group", F.floor(F.col("bin") / GROUP))
    groups = bins.groupBy("source", "group").agg(
        F.sum("words").alias("words"), F.first("rest").alias("rest")
    )
    group = _first_over(groups.withColumn("before", F.lit(0)), "group")
    inside = _with_source(bins, group).where(F.col("group") == F.col("cut"))
    ranked = _with_source(ranked, _first_over(inside, "bin").withColumnRenamed("cut", "cut_bin"))

    # Without a cut, all documents together do not exceed the rest: all are taken.
    sure_extra = F.when(F.col("part") > 0, F.coalesce(F.col("bin") < F.col("cut_bin"), F.lit(True)))
    at_cut = F.coalesce(F.col("bin") == F.col("cut_bin"), F.lit(False))
    plain = ranked.where(~at_cut).withColumn(
        "extra", F.when(F.coalesce(sure_extra, F.lit(False)), 1).otherwise(0)
    )
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    cut = ranked.where(at_cut).withColumn(
        "extra", F.when(earlier + F.col("size") / 2 <= F.col("rest"), 1).otherwise(0)
    )
    copies = (F.col("sure") + F.col("extra")).cast("int")
    return plain.unionByName(cut).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def _first_over(parts: DataFrame, place: str) -> DataFrame:
    """``(source, cut, before)``: the first part of a source whose words pass the rest."""
    upto = F.sum("words").over(Window.partitionBy("source").orderBy(place)) + F.col("before")
    over = parts.withColumn("upto", upto).where("upto > rest")
    first = F.min(F.struct(F.col(place), (F.col("upto") - F.col("words")).alias("before")))
    return over.groupBy("source").agg(first.alias("first")).select(
        "source", F.col("first").getField(place).alias("cut"), "first.before"
    )


def _with_source(df: DataFrame, per_source: DataFrame) -> DataFrame:
    """Add the row of its source, null meeting null; adaptive execution picks the join."""
    right = per_source.withColumnRenamed("source", "_source")
    return df.join(right, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
