"""Stages of the pipeline on planted rows, against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np

import corpus_pipeline
from mailloom.llm import quality, samples
from tests.llm.data import documents, labels, words


def _planted():
    """Passages of 51 to 60 words, some short ones, each in two or three documents."""
    draw = random.Random(6)
    passages = []
    for k in range(12):
        n = draw.randrange(51, 61)
        short = k % 3 == 0
        passages.append(" ".join(
            "".join(draw.choices("abcdefghijk", k=draw.randrange(2, 4) if short else draw.randrange(4, 9)))
            for _ in range(n)
        ))
    rows = []
    for k in range(40):
        own = [words(60, 1000 + k, 4000), words(50, 2000 + k, 4000)]
        rows.append((k, f" {passages[k // 3]} ".join(own) if k < 36 else " ".join(own)))
    # A phrase of 20 words that recurs is no passage.
    phrase = words(20, 77)
    rows += [(100 + k, f"{words(40, 3000 + k, 4000)} {phrase} {words(40, 4000 + k, 4000)}") for k in range(5)]
    return rows + [(200, None), (201, ""), (None, "no id")], passages


def _brute(texts, window, least):
    raws = [(text or "").encode() for text in texts]
    many = Counter(raw[k:k + window] for raw in raws for k in range(len(raw) - window + 1))
    kept = []
    for text, raw in zip(texts, raws):
        gone = np.zeros(len(raw) + 2, bool)
        for k in range(len(raw) - window + 1):
            if many[raw[k:k + window]] > 1:
                gone[k + 1:k + window + 1] = True
        out, at = b"", 0
        edges = np.flatnonzero(np.diff(gone))
        for start, end in edges.reshape(-1, 2):
            if len(raw[start:end].split()) >= least:
                out, at = out + raw[at:start], end
        out += raw[at:]
        kept.append(None if text is None else out.decode("utf-8", "ignore"))
    return kept


def test_passages_go_and_the_rest_stays(spark):
    rows, passages = _planted()
    found = corpus_pipeline.no_repeats(spark, documents(spark, rows), None)
    assert found.columns == documents(spark, rows).columns
    have = {r["doc_id"]: r["text"] for r in found.collect()}
    want = _brute(
        [text for _, text in rows], corpus_pipeline.WINDOW, corpus_pipeline.PASSAGE_WORDS
    )
    assert have == dict(zip([i for i, _ in rows], want))
    long = [p for p in passages if len(p) >= corpus_pipeline.WINDOW]
    assert len(long) >= 11
    assert not any(p in (text or "") for p in long for text in have.values())
    assert all(have[i] == text for i, text in rows if i is None or i >= 36)


def test_labels_of_other_documents_take_no_place(spark):
    docs = documents(spark, [(k, words(30, k)) for k in range(400)])
    many = spark.range(100_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    found = samples.labelled_texts(docs, many, "quality", rows=300).collect()
    assert len(found) == 300
    assert {r["label"] for r in found} == {0, 1}


def test_ids_of_any_type(spark):
    rows = [(k, words(40, k, 50 if k % 2 else 4000)) for k in range(300)]
    docs = documents(spark, rows).selectExpr("'d' || doc_id AS doc_id", "text", "lang")
    marks = labels(spark, [(k, k % 2, 0, "x") for k in range(300)]).selectExpr(
        "'d' || doc_id AS doc_id", "quality")
    kept = quality.good(docs, marks)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {f"d{k}" for k in range(1, 300, 2)}
