"""A corpus pipeline in five stages over the documents.

``STAGES`` lists names and functions of ``(spark, docs, sf_dir)``. Each stage returns the
documents it keeps with all their columns, the last one the mix: per document how often
it is taken. ``run`` applies them one after the other; each result is written to the
shared folder and read again, so that an executor lost in a later stage costs nothing of
an earlier one.

Nulls, ties and odd rows are as each operator's docstring says: a null text is an empty one,
a null id is a document like any other, rows that repeat are copies of which one stays, a
label without a document has no effect, and an empty table gives no rows. Other columns of
the documents pass through all stages but the last.
"""

from __future__ import annotations

from mailloom.llm import contamination, mixing, quality, simhash, suffix_dedup
from mailloom.llm.common import prepare, remove, settled, table


def good_quality(spark, docs, sf_dir):
    """Documents that the quality classifier does not reject."""
    prepare(spark)
    return quality.good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark, docs, sf_dir):
    """One document of each group of near duplicates."""
    prepare(spark)
    return simhash.keep_one(docs)


#: A passage that goes has so many words. Strings of WINDOW bytes that occur twice are looked
#: for; a passage of that many words is rarely shorter.
PASSAGE_WORDS, WINDOW, GRAM = 50, 160, 40


def no_repeats(spark, docs, sf_dir):
    """Documents without the passages that occur anywhere else as well."""
    prepare(spark)
    return suffix_dedup.without_repeats(docs, WINDOW, GRAM, PASSAGE_WORDS)


def no_benchmark(spark, docs, sf_dir):
    """Documents that hold too little of the benchmark to be contaminated."""
    prepare(spark)
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark, docs, sf_dir):
    """How often the mix takes each document that is left."""
    prepare(spark)
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("near duplicates", one_of_each),
    ("suffix-array dedup", no_repeats),
    ("decontamination", no_benchmark),
    ("mixing", mixture),
]

#: A trained classifier and a suffix array cannot be written as SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage over all documents."""
    docs, last = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs, folder = settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
        if last:
            remove(spark, last)
        last = folder
    return docs
