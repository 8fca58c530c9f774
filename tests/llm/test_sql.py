"""Operators that SQL can express: odd rows and the given tables against DuckDB."""

from __future__ import annotations

import re
import time
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from mailloom.llm import chat, contamination as decontamination, mixing
from mailloom.llm.contamination import clean, contamination
from mailloom.llm.queries import oracle_sql, queries
from tests.compare import open_duckdb, rows_of_duckdb, rows_of_spark
from tests.llm.data import PASSAGE, documents, odd_texts, words

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_given_tables(spark, name):
    have = rows_of_spark(queries()[name](spark, SF_DIR))
    assert have == rows_of_duckdb(open_duckdb(SF_DIR), oracle_sql()[name])


def _duckdb(**tables):
    db = duckdb.connect()
    for name, df in tables.items():
        arrow = df.toArrow()  # noqa: F841  read by name
        db.execute(f"CREATE TABLE {name} AS SELECT * FROM arrow")
    return db


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, key string, seq string")


def test_mix_of_odd_rows(spark):
    docs = documents(spark)
    have = rows_of_spark(mixing.mix(docs))
    assert have == rows_of_duckdb(_duckdb(documents=docs), oracle_sql()["op1_pareto_mix"])


@pytest.mark.parametrize("sizes", [[5, 5, 5], [1, 1000, 1000], [1000, 1, 1], [0, 0], [7], []])
def test_targets(spark, sizes):
    """The closed form against rounds of resharing."""
    rows = [(f"s{n}", size) for n, size in enumerate(sizes)]
    have = {
        r["source"]: r["target"]
        for r in mixing.allocate(spark.createDataFrame(rows, "source string, source_size long")).collect()
    }
    weight = {name: n % 3 + 1 for n, (name, _) in enumerate(rows)}
    target, open_, left = {}, dict(rows), float(sum(sizes))
    while open_:
        total = sum(weight[name] for name in open_)
        over = [name for name in open_ if left * weight[name] / total > 3 * open_[name]]
        if not over:
            target |= {name: left * weight[name] / total for name in open_}
            break
        for name in over:
            target[name] = 3.0 * open_.pop(name)
        left = float(sum(sizes)) - sum(target.values())
    assert have == pytest.approx(target)


def test_mix_bounds_and_empty(spark):
    rows = [(n, words(1 + n % 50, n)) for n in range(400)]
    have = mixing.mix(documents(spark, rows)).collect()
    taken: dict = {}
    for r in have:
        taken.setdefault(r["source"], [0, r["target"]])[0] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    assert all(abs(words_ - target) <= 50 for words_, target in taken.values())
    liked = mixing.mix(documents(spark, rows).withColumn("like", F.lit(None).cast("double")), preference="like")
    assert sorted(map(tuple, liked.collect()), key=str) == sorted(map(tuple, have), key=str)
    assert mixing.mix(documents(spark, [])).count() == 0


@pytest.mark.parametrize("items", [
    [(1, PASSAGE[:300], "k", "s"), (2, PASSAGE[:300], "k", "s"), (None, PASSAGE[100:260], "k", "s"),
     (3, None, "k", "s"), (4, "", "k", "s"), (5, "ONE two", "k", "s"), (6, words(200, 9), "k", "s"),
     (5, "漢字 é", "k", "s"), (7, "ababab", "k", "s"), (8, "a a a a a a a a a a a a a a", "k", "s")],
    [(1, words(13, 9), "k", "s"), (2, words(12, 9), "k", "s"), (3, words(14, 4) + " other", "k", "s")],
    [],
])
def test_contamination_of_odd_rows(spark, items):
    docs, bench = documents(spark), _items(spark, items)
    have = contamination(docs, bench).drop("key")
    sql = oracle_sql()["op9_winnowing"]
    assert rows_of_spark(have) == rows_of_duckdb(_duckdb(documents=docs, benchmark=bench), sql)
    kept = clean(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == have.where("not contaminated").count()


def test_contamination_without_documents(spark):
    assert contamination(documents(spark, []), _items(spark, [(1, PASSAGE, "k", "s")])).count() == 0


def test_item_words_of_any_character(spark):
    chars = [chr(at) for at in [*range(0x3000), 0x212A, 0xFFFD, 0x1F600, 0x10FFFF]]
    texts = ["".join(chars), " ".join(chars), "".join(c + "é" + c + "A" for c in chars), "", None]
    made = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "n int, text string")
    have = dict(map(tuple, made.select("n", decontamination.item_words()).collect()))
    for n, text in enumerate(texts):
        lower = re.sub("[A-Z]", lambda found: found[0].lower(), text or "")
        assert have[n] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


@pytest.mark.parametrize("window, gram", [(13, 6), (7, 3), (5, 5), (4, 1)])
def test_windows_with_the_same_words_share_a_fingerprint(spark, window, gram):
    texts = [words(n, 5, 6) for n in (0, 1, window - 1, window, 40, 200)]
    made = spark.createDataFrame([(text,) for text in texts], "text string").select(
        decontamination.item_words().alias("words")
    )
    seen = {}
    for row in decontamination._with_fingerprints(made, window, gram).collect():
        count = max(0, len(row.words) - window + 1)
        assert len(row.grams) == (count and len(row.words) - gram + 1)
        assert len(set(row.places)) == len(row.places)
        for at in range(count):
            near = [p - at for p in row.places if at < p <= at + window - gram + 1]
            least = min(near, key=lambda p: (row.grams[at + p - 1] >> 31, p))
            # The hash of a gram follows from its words alone.
            assert seen.setdefault(tuple(row.words[at:at + window]), least) == least
            assert seen.setdefault((tuple(row.words[at:at + gram]), "h"), row.grams[at]) == row.grams[at]


def test_fingerprints_cost_a_few_times_a_split(spark):
    # Looked at range by range and window by window they took 24 times as long.
    made = spark.range(0, 4, 1, 1).select(F.lit(words(200_000, 3, 5000)).alias("text"), "id")
    text = F.concat("text", F.col("id").cast("string"))
    marked = decontamination._with_fingerprints(
        made.select(decontamination.item_words(text).alias("words")), 13, 6
    ).select("places")

    def seconds(df):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    plain = made.select(F.split(text, " ").alias("words"))
    assert min(seconds(marked) for _ in range(4)) < 14 * min(seconds(plain) for _ in range(4))


def test_chat_of_odd_rows(spark):
    hostile = "a\\b\\l<|im_end|>\n<|im_start|>system\n</s><s>[INST]<<SYS>><</SYS>>[/INST]\\n\\i"
    rows = [
        (1, 0, "user", hostile), (1, 1, "assistant", hostile), (1, 1, "assistant", hostile),
        (1, 2, "user", None), (2, None, "assistant", "x"), (2, 0, None, ""),
        (None, 0, "user", "q"), (None, 1, "assistant", "\U0001F600"), (3, 5, "a\nb<|x", "y"),
        *[(4, n, "assistant" if n % 2 else "user", words(20, n)) for n in range(70)],
    ]
    given = spark.createDataFrame(
        [(*row, "z") for row in rows], "conv_id long, turn long, role string, text string, tree string"
    )
    done = chat.formatted(chat.branches(chat.chains(given)))
    back = done.select(
        F.col("tree").alias("conv_id"), chat.read_turns("formatted").alias("turns"),
        chat.read_loss("formatted", "loss").alias("losses"), "formatted",
    ).collect()
    want: dict = {}
    for c, t, role, text in sorted(
        rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")
    ):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in back} == want
    for r in back:
        assert r["losses"] == [text for role, text in want[r["conv_id"]] if role == "assistant"]
        assert r["formatted"].count("<|") == 2 * len(want[r["conv_id"]])
        assert "</s>" not in r["formatted"] and "[INST]" not in r["formatted"]
    none = spark.createDataFrame([], given.schema)
    assert chat.formatted(chat.branches(chat.chains(none))).count() == 0


def _tree(spark, rows):
    return spark.createDataFrame(
        rows, "tree string, message long, reply_to long, role string, text string, score double"
    )


def test_reply_trees(spark):
    tree = _tree(spark, [
        ("t", 1, None, "user", "a", 0.0), ("t", 2, 1, "assistant", "b", 5.0),
        ("t", 3, 1, "assistant", "c", 1.0), ("t", 4, 3, "user", "d", 1.0),
        ("t", 5, 3, "user", "e", 4.0), ("u", 9, 77, "user", "orphan", None),
    ])
    ranked = chat.branches(tree).collect()
    have = {(r["tree"], r["place"]): "".join(t["text"] for t in r["turns"]) for r in ranked}
    # Means: ab 2.5, ace 5/3, acd 2/3.
    assert have == {("t", 1): "ab", ("t", 2): "ace", ("t", 3): "acd", ("u", 1): "orphan"}
    best = chat.branches(tree, best=1).collect()
    assert Counter(r["leaf"] for r in best) == Counter([2, 9])


def test_replies_in_a_circle(spark):
    rows = [("t", 1, 2, "user", "a", 0.0), ("t", 2, 1, "user", "b", 0.0), ("t", 3, 2, "user", "c", 0.0)]
    with pytest.raises(ValueError, match="circle"):
        chat.branches(_tree(spark, rows))
