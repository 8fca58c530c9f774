"""Operators on single texts and pages: counts by brute force, models on held-out rows."""

from __future__ import annotations

import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mailloom.llm import deobfuscation, quality, rules, samples, toxicity
from mailloom.llm.common import table
from mailloom.llm.html import extracted, main_text
from tests.llm.data import documents, labels, odd_texts

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def given(spark):
    docs, marks = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    return docs, marks, {r["doc_id"]: r for r in marks.collect()}


def _held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


def _odd_labels(spark):
    return labels(spark, [
        (4, 1, 0, "x"), (5, 0, 1, "x"), (5, 1, 0, "x"), (6, None, None, "x"), (None, 1, 1, "x"),
        (9, 1, 0, "x"), (9, 1, 0, "x"), (999, 0, 1, "x"),
    ])


def _counts(text):
    words = WORD.findall(text or "")
    many = Counter(zip(words, words[1:], words[2:]))
    again = set()
    for k in range(len(words) - 2):
        if many[tuple(words[k:k + 3])] > 1:
            again |= {k, k + 1, k + 2}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(again),
    )


def test_rule_counts(spark):
    rows = [*odd_texts(), (50, "a b c a b c a b"), (51, "x\n\nx\n x\nx y|z #$\n"), (52, "é" * 9)]
    have = rules.judged(documents(spark, rows), _odd_labels(spark)).collect()
    want = Counter()
    for i, text in rows:
        found = _counts(text)
        want[i, *found, found[0] < 50 or 100 * found[4] > 50 * found[0]] += 1
    assert Counter(tuple(r)[:7] for r in have) == want
    assert all(not r["kept"] for r in have if r["base_failed"])
    assert all(0 <= r["probability"] <= 1 for r in have)


def test_rules_on_held_out_rows(given):
    docs, marks, known = given
    rows = [r for r in rules.judged(docs, marks).collect() if r["doc_id"] in known]
    for held in (False, True):
        fold = [r for r in rows if _held_out(r["doc_id"]) == held]
        good = [r["kept"] or r["base_failed"] for r in fold if known[r["doc_id"]]["quality"] == 1]
        bad = [r["kept"] for r in fold if known[r["doc_id"]]["quality"] == 0]
        assert np.mean(good) > 0.97 and np.mean(bad) < 0.15


def test_calibration():
    draw = np.random.default_rng(2)
    value = draw.normal(size=4000)
    label = (draw.random(4000) < 1 / (1 + np.exp(-(2 * value - 1)))).astype(float)
    slope, offset = rules.calibrate(value, label)
    assert slope == pytest.approx(2, abs=0.2) and offset == pytest.approx(-1, abs=0.2)


def _fold_means(found, known, label):
    """Share predicted 1 among held-out rows that are, and that are not."""
    rows = [r for r in found if r["doc_id"] in known and r["held_out"]]
    yes = [r["predicted"] for r in rows if known[r["doc_id"]][label] == 1]
    no = [r["predicted"] for r in rows if known[r["doc_id"]][label] == 0]
    return np.mean(yes), np.mean(no)


def test_quality_on_held_out_rows(given):
    docs, marks, known = given
    yes, no = _fold_means(quality.scored(docs, marks).collect(), known, "quality")
    assert yes > 0.97 and no < 0.15


def test_toxicity_on_held_out_rows(given):
    docs, marks, known = given
    yes, no = _fold_means(toxicity.scored(docs, marks).collect(), known, "toxic")
    assert yes > 0.4 and no < 0.02


def test_disguises(given):
    letters = deobfuscation.Letters(toxicity.letter_counts(given[0]))
    for word, shapes in {
        "idiot": ["1d10t", "i d i o t", "i.d.i.o.t", "id-iot", "iiidiooot", "id​iot", "IDI0T!!"],
        "moron": ["m0r0n", "m o r o n", "mooooron"], "clown": ["cl0wn", "c-l-o-w-n"],
        "stupid": ["5tup1d", "s t u p i d!", "$tupid", "st.upid"], "trash": ["tr@sh", "tra$h###"],
    }.items():
        for shape in shapes:
            assert word in deobfuscation.restored(f"so {shape} said", letters, {}), shape
    assert deobfuscation.restored("", letters, {}) == set()
    assert deobfuscation.restored("a a a a " * 50, letters, {})
    assert deobfuscation.restored("the 12th of may, 3.5 kg", letters, {}) >= {"the", "of", "may"}


def test_disguises_at_the_end_and_other_separators():
    vocabulary = "idiot trash hate hated ass the hat so said then word or is at as".split()
    letters = deobfuscation.Letters(Counter(
        run for word in vocabulary * 50 for run in deobfuscation.word_runs(word)
    ))
    for word, shapes in {
        "idiot": ["i,d,i,o,t", "i/d/i/o/t", "i\nd\ni\no\nt", "i~d~i~o~t", "id/iot", "id,iot", "idio7"],
        "trash": ["tras#", "tr,ash"], "hate": ["hat3", "h8", "hat3,", "hat3!!"], "ass": ["a$$", "a$$."],
    }.items():
        for shape in shapes:
            assert word in deobfuscation.restored(f"so {shape} said", letters, {}), shape
    for plain in ("so ### !!! then", "word!!! word### word! word"):
        assert deobfuscation._FOUND.search(plain) is None


@pytest.mark.parametrize("score", [quality.scored, toxicity.scored])
def test_scores_of_odd_rows(spark, score):
    docs = documents(spark)
    have = score(docs, _odd_labels(spark)).collect()
    assert Counter(r["doc_id"] for r in have) == Counter(i for i, _ in odd_texts())
    assert all(0 <= r["score"] <= 1 and r["held_out"] == _held_out(r["doc_id"]) for r in have)
    empty = {r["score"] for r in have if r["doc_id"] in (1, 2, 3)}
    assert len(empty) == 1
    assert score(documents(spark, []), _odd_labels(spark)).count() == 0
    none = score(docs, labels(spark, [])).collect()
    assert {r["score"] for r in none} == {0.5}


def _with_long_texts(spark, sizes):
    """200 labelled documents by id, those of ``sizes`` of so many bytes, without blanks."""
    ids = spark.range(1, 201).withColumnRenamed("id", "doc_id")
    usual = F.when(F.col("doc_id") % 2 == 0, "a calm and even text").otherwise("buy buy !!! now")
    long = spark.createDataFrame(list(sizes.items()), "doc_id long, size int")
    text = F.coalesce(F.expr("repeat('y', size)"), usual)
    marks = ids.selectExpr("doc_id", "CAST(1 - doc_id % 2 AS INT) quality", "CAST(doc_id % 2 AS INT) toxic")
    return ids.join(F.broadcast(long), "doc_id", "left").select("doc_id", text.alias("text")), marks


def _by_hash(spark):
    """Ids outside the held-out fold, in the order of the sample."""
    ids = spark.range(1, 201).orderBy(F.xxhash64("id")).collect()
    return [r["id"] for r in ids if not _held_out(r["id"])]


def test_a_long_text_does_not_empty_the_sample(spark):
    order = _by_hash(spark)
    docs, marks = _with_long_texts(spark, {order[0]: samples.SAMPLE_BYTES + 1})
    for label in ("quality", "toxic"):
        have = samples.labelled_texts(docs, marks, label)
        assert {r["doc_id"] for r in have.select("doc_id").collect()} == set(order)
    good = {r["doc_id"]: r["score"] for r in quality.scored(docs, marks).collect()}
    assert all((good[i] > 0.5) == (i % 2 == 0) for i in set(good) - {order[0]})


def test_long_texts_come_last(spark):
    order = _by_hash(spark)
    docs, marks = _with_long_texts(spark, {order[0]: 90_000, order[1]: 70_000, order[2]: 80_000})

    def taken(most_bytes):
        have = samples.labelled_texts(docs, marks, "quality", most_bytes=most_bytes)
        return {r["doc_id"] for r in have.collect()}

    assert taken(75_000) == set(order) - {order[0], order[2]}
    assert taken(160_000) == set(order) - {order[0]}
    assert taken(250_000) == set(order)
    # Where all are long, as many as fit are taken all the same.
    docs, marks = _with_long_texts(spark, {i: 100_000 + n for n, i in enumerate(order)})
    assert taken(300_003) == set(order[:3])


def test_models_do_not_see_the_held_out_fold(given, spark):
    docs, marks, _ = given
    flipped = marks.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality ELSE quality END"
        " AS quality", "toxic")
    have, other = (
        {r["doc_id"]: r["score"] for r in quality.scored(docs, m).collect()} for m in (marks, flipped)
    )
    assert have == other


PARAGRAPH = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor labore."
PAGES = {
    "divisions": (
        f"<body><div id='header'><h1>Site</h1></div><div class=menu><ul><li><a href=#>Home</a></ul>"
        f"</div><div id=content><h2>T</h2><p>{PARAGRAPH}</p><p>Short.</p><p>{PARAGRAPH}</p></div>"
        f"<div class=sidebar><p>{PARAGRAPH}</p></div><div id=comments>{PARAGRAPH}</div>",
        f"T {PARAGRAPH} Short. {PARAGRAPH}"),
    "article": (
        f"<header><p>Site</p></header><div class='cookie-notice'>{PARAGRAPH}</div><main><article>"
        f"<header><h1>T</h1><p>By</p></header><p>A &amp; B&nbsp; c\n<b>d</b>e</p><aside>{PARAGRAPH}"
        f"</aside><form>{PARAGRAPH}</form><script>if (a<b) x('<p>')</script><ul><li>x<li>y</ul>"
        f"<p>{PARAGRAPH}<section class=comments><p>{PARAGRAPH}</section></article></main><footer>c",
        f"T A & B c de x y {PARAGRAPH}"),
    "left open": (
        f"<nav><ul><li><a>a</a></ul><div class=ad>ad <article><p>{PARAGRAPH}</p>tail</article>",
        f"{PARAGRAPH} tail"),
    "two articles": (
        f"<article><p>{PARAGRAPH} one</p></article><article><p>{PARAGRAPH} two</p></article>",
        f"{PARAGRAPH} one {PARAGRAPH} two"),
    "around the article": (
        f"<main><h1>T</h1><p>{PARAGRAPH}</p><article><p>{PARAGRAPH}</p></article></main>",
        f"T {PARAGRAPH} {PARAGRAPH}"),
    "article in article": (
        f"<article><p>{PARAGRAPH} a</p><article><p>{PARAGRAPH} b</p></article><p>{PARAGRAPH} c</p>"
        f"</article>", f"{PARAGRAPH} a {PARAGRAPH} b {PARAGRAPH} c"),
    "names in the text": (
        f"<article><h2 id='copyright-law'>Law</h2><p>{PARAGRAPH} <em class=notice>d</em></p>"
        f"<div class=notice>{PARAGRAPH}</div></article>", f"Law {PARAGRAPH} d"),
    "no blocks": (PARAGRAPH, PARAGRAPH),
    "empty": ("", ""), "null": (None, ""), "markup alone": ("<div><p></p></div>", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    html, text = PAGES[name]
    assert main_text(html) == text


@pytest.mark.parametrize("html", [
    "<div>" * 100_000 + "x", "<p>" + "<b>" * 100_000 + "x" + "</i>" * 100_000])
def test_deep_nesting_takes_time_in_proportion(html):
    start = time.process_time()
    assert main_text(html) == "x"
    assert time.process_time() - start < 8


def test_given_pages(spark):
    pages = table(spark, SF_DIR, "pages")
    rows = {r["page_id"]: r for r in extracted(pages).collect()}
    for page in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", page["html"], re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|br|h1)>", " ", inner))
        if "&" not in plain:
            assert rows[page["page_id"]]["text"] == " ".join(plain.split())
        assert rows[page["page_id"]]["n_chars"] == len(rows[page["page_id"]]["text"])


def test_odd_pages(spark):
    schema = "page_id long, url string, html string, text string"
    long = f"<article>{'<p>' + PARAGRAPH:}</article>" + "<div>x</div>" * 5000
    pages = spark.createDataFrame(
        [(1, "u", None, "t"), (None, None, "", "t"), (2, "u", long, "t"), (2, "u", long, "t")], schema)
    have = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in extracted(pages).collect())
    assert have == [("1", "", 0), ("2", PARAGRAPH, len(PARAGRAPH)), ("2", PARAGRAPH, len(PARAGRAPH)),
                    ("None", "", 0)]
    assert extracted(spark.createDataFrame([], schema)).count() == 0


def test_pipeline(spark, tmp_path):
    """The stages on odd rows: each keeps all columns, and what it has to keep."""
    odd = str(tmp_path)
    _odd_labels(spark).write.parquet(f"{odd}/labels.parquet")
    spark.createDataFrame([(1, "no such words here")], "item_id long, text string").write.parquet(
        f"{odd}/benchmark.parquet")
    for rows in (odd_texts(), []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, odd)
            assert out.columns == docs.columns, name
            folder = f"{odd}/{len(rows)}-{name}"
            out.write.parquet(folder)
            kept = spark.read.parquet(folder)
            assert kept.count() <= docs.count()
            docs = kept
        last = corpus_pipeline.STAGES[-1][1](spark, docs, odd)
        assert last.count() == docs.count()


def test_pipeline_run(spark):
    have = corpus_pipeline.run(spark, SF_DIR)
    rows = have.collect()
    assert 500 < len(rows) < 1000
    assert len({r["doc_id"] for r in rows}) == len(rows)
