"""Benchmark decontamination by winnowing.

Of every ``WINDOW - GRAM + 1`` runs of ``GRAM`` words that follow each other, the one with
the least hash is a fingerprint. A span of ``WINDOW`` words that a document shares with
an item has the same fingerprint at the same place on both sides, so the join of the
fingerprints finds every such span. Each hit is extended over all the item's words that
the document has beside it; runs of equal words that are long enough are hits of the
document's words. Items of fewer words than a window are one window of their own
length: they are found by the hash of all their words.

Everything is built-in functions. Items with the same words are one sequence until the
end; rows with the same text are looked at once. A fingerprint that very many documents
share meets a few item rows; these are broadcast where they are measured to be small,
and else joined with a salt.

Nulls, ties and odd rows: null has no words and holds no hit; an item without words
occurs nowhere. Rows that repeat have the same result each. An item without an id can
contaminate but is not counted or listed; an id that occurs in several rows is listed
once. Extra columns are passed over by :func:`contamination` and kept by :func:`clean`.
Empty tables give no rows, an empty benchmark no hits.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailloom.llm.common import packed, stored, text_key, unpacked
from mailloom.operators.joins import lookup_join

#: Words of a shared span, and of the runs that are hashed.
WINDOW, GRAM = 13, 6

#: Words are letters and digits; any character beyond ASCII is part of a word. A class that
#: says what is not in a word is tested range by range for each character, and far slower.
PATTERN = r"[0-9a-z\x{80}-\x{10FFFF}]+"


def item_words(text="text"):
    """The words of a text, with A to Z in lower case."""
    lower = F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )
    return F.regexp_extract_all(lower, F.lit(PATTERN), 0)


def _with_runs(df: DataFrame, values: str, length: int, joined) -> DataFrame:
    """The array ``values`` with, at each place, the ``length`` values from there on put together.

    ``joined`` puts two neighbours together, each of which may be several values; where they
    overlap it has to bear that. A run is made of two shorter runs, so each value is touched a
    few times and no run is copied. Runs that go past the end are left out.
    """
    span = 1
    while span < length:
        step = min(span, length - span)
        df = df.withColumn(values, F.zip_with(
            values, F.slice(values, step + 1, F.size(values)), joined
        ))
        span += step
    whole = F.greatest(F.size(values) - length + 1, F.lit(0))
    return df.withColumn(values, F.slice(values, 1, whole))


#: The bits of a place in a key, beside a gram's hash; an array has fewer than 2^31 places.
_PLACE = (1 << 31) - 1


def _with_fingerprints(worded: DataFrame, window: int, gram: int) -> DataFrame:
    """``grams``, the hash of the run of words at each place, and ``places`` (from 1) of the
    fingerprints; both are empty for fewer words than a window."""
    hashed = worded.withColumn("grams", F.when(
        F.size("words") >= window, F.transform("words", lambda word: F.xxhash64(word))
    ).otherwise(F.array().cast("array<bigint>")))
    grams = _with_runs(hashed, "grams", gram, lambda a, b: F.xxhash64(a, b))
    # The place in the low bits: the least key is the leftmost of the least hashes. Windows
    # with the same words have it at the same word, wherever they are.
    keyed = grams.withColumn("places", F.transform(
        "grams", lambda h, at: h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR((at + 1).cast("long"))
    ))
    least = _with_runs(keyed, "places", window - gram + 1, lambda a, b: F.least(a, b))
    return least.withColumn("places", F.transform(
        F.array_distinct("places"), lambda key: key.bitwiseAND(F.lit(_PLACE)).cast("int")
    ))


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    items = stored(
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), item_words().alias("item"))
        .where(F.size("item") > 0)
        .withColumn("seq", F.unhex(F.md5(F.concat_ws(" ", "item"))))
    )
    seqs = items.groupBy("seq").agg(F.first("item").alias("item"))
    seqs = stored(seqs.withColumn("need", F.least(F.size("item"), F.lit(window))))

    def spread(marked: DataFrame, *ids: str) -> DataFrame:
        return marked.select(*ids, F.inline(F.arrays_zip("places", "hashes"))).withColumnsRenamed(
            {"places": "place", "hashes": "h"}
        )

    hashes = F.transform("places", lambda at: F.element_at("grams", at)).alias("hashes")
    marked = _with_fingerprints(
        documents.select("doc_id", text_key().alias("key"), item_words().alias("words")),
        window, gram,
    )
    marked = stored(marked.select(
        "doc_id", "key", F.size("words").cast("long").alias("n_words"), "places", hashes,
    ))
    # Written before they are spread: the filter that comes with a spread array would
    # otherwise repeat all that the array is made from.
    tests = stored(_with_fingerprints(
        seqs.withColumnRenamed("item", "words"), window, gram
    ).select("seq", "places", hashes))
    tests = spread(tests, "seq").withColumnRenamed("place", "item_place")
    hits = lookup_join(
        spread(marked, "key"), tests, ["h"], how="inner", spread=["key", "place"]
    ).select("key", "seq", (F.col("place") - F.col("item_place")).alias("shift"))
    hits = hits.unionByName(_short_hits(documents, seqs, window)).distinct()
    hits = stored(hits)

    words = _hit(documents, marked, hits, seqs)
    by_doc = words.groupBy("key").agg(F.countDistinct("at").alias("n_hit"))
    named = words.select("key", "seq").distinct().join(items.select("seq", "item_id"), "seq")
    lists = named.groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    found = by_doc.join(lists, "key", "left").select(
        F.col("key").alias("_key"), "n_hit", F.coalesce("ids", F.array().cast("array<string>"))
        .alias("ids")
    )
    found = stored(found.select(
        "_key", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "ids").cast("binary"), 256).alias("items_sha256"),
    ))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return marked.select("doc_id", "key", "n_words").join(
        found, F.col("key") == F.col("_key"), "left"
    ).select(
        "doc_id", "key", "n_words", n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def _short_hits(documents: DataFrame, seqs: DataFrame, window: int) -> DataFrame:
    """Places of items with fewer words than a window, by the hash of all their words."""
    short = seqs.where(F.size("item") < window)
    # There are fewer lengths than words in a window.
    lengths = sorted(row["n"] for row in short.select(F.size("item").alias("n")).distinct().collect())
    if not lengths:
        return seqs.sparkSession.createDataFrame([], "key binary, seq binary, shift int")
    tests = stored(short.select("seq", F.size("item").alias("n"), F.xxhash64("item").alias("h")))
    at = documents.select(text_key().alias("key"), item_words().alias("words")).select(
        "key", "words", F.posexplode("words").alias("shift", "_word")
    )
    runs = F.explode(F.array(*[
        F.when(F.col("shift") + n <= F.size("words"), F.struct(
            F.lit(n).alias("n"), F.xxhash64(F.slice("words", F.col("shift") + 1, n)).alias("h")
        )) for n in lengths
    ]))
    spread = at.select("key", "shift", runs.alias("run")).where("run is not null").select(
        "key", "shift", F.col("run.n").alias("n"), F.col("run.h").alias("h")
    )
    return lookup_join(
        spread, tests, ["n", "h"], how="inner", spread=["key", "shift"]
    ).select("key", "seq", "shift")


def _hit(documents: DataFrame, marked: DataFrame, hits: DataFrame, seqs: DataFrame) -> DataFrame:
    """``(key, seq, at)``: the hit words, from the hits extended over their items."""
    ids = marked.join(hits.select("key").distinct(), "key", "left_semi").groupBy("key").agg(
        F.min("doc_id").alias("_doc")
    )
    ids = stored(ids.select(F.col("key"), F.col("_doc").cast("string").alias("_doc")))
    # One row for each text that has a hit.
    texts = lookup_join(
        documents.select(F.col("doc_id").cast("string").alias("_id"), "text", text_key().alias("key")),
        ids, ["key"], how="inner", spread=["_id"],
    ).where(F.col("_id").eqNullSafe(F.col("_doc")))
    texts = stored(
        texts.groupBy("key").agg(F.first("text").alias("text"))
        .select("key", item_words().alias("words"))
    )
    # Adaptive execution splits an item that very many documents hold.
    pairs = hits.join(texts, "key").join(seqs, "seq")
    # The part of the item that has words of the document beside it.
    first = F.greatest(F.lit(0), -F.col("shift"))
    many = F.least(F.size("item"), F.size("words") - F.col("shift")) - first
    beside = pairs.where(many > 0).select(
        "key", "seq", "need", (F.col("shift") + first).alias("start"), "shift",
        F.posexplode(F.zip_with(
            F.slice("words", F.col("shift") + first + 1, many), F.slice("item", first + 1, many),
            lambda a, b: a == b,
        )).alias("n", "equal"),
    ).where("equal")
    hit = Window.partitionBy("key", "seq", "shift")
    runs = beside.withColumn("run", F.col("n") - F.row_number().over(hit.orderBy("n")))
    size = F.count(F.lit(1)).over(Window.partitionBy("key", "seq", "shift", "run"))
    return stored(
        runs.withColumn("size", size).where(F.col("size") >= F.col("need"))
        .select("key", "seq", (F.col("start") + F.col("n")).alias("at")).distinct()
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = contamination(documents.select("doc_id", "text"), benchmark)
    bad = stored(found.where("contaminated").select(F.col("key").alias("_bad")).distinct())
    keyed = packed(documents).withColumn("_key", text_key("doc.text"))
    return unpacked(
        keyed.join(bad, F.col("_key") == F.col("_bad"), "left_anti"), documents.columns
    )
