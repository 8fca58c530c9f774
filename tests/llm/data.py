"""Small tables with nulls, ties, repeated rows, long texts and clashing columns."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key string, score string, size string, doc string, _key string, at string, g string"
)


def words(n: int, seed: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary):03d}" for _ in range(n))


#: About 100 words, held by many documents between words of their own.
PASSAGE = words(100, 7)


def odd_texts() -> list[tuple[int | None, str | None]]:
    long = words(6000, 11)
    rows: list[tuple[int | None, str | None]] = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One TWO"), (6, long),
        (7, long), (7, long), (None, words(120, 3)), (None, None), (None, words(120, 3)),
        (8, words(200, 4)), (8, words(200, 5)), (9, "é ñ ß 漢字 \U0001F600 \x0b\x0c nbsp x " * 30),
        (10, "ab" * 700), (11, "a " * 90), (12, words(200, 4) + " end"),
    ]
    rows += [
        (100 + k, f"{words(40, 100 + k)}\n{PASSAGE} {words(30, 200 + k)}") for k in range(30)
    ]
    rows += [(200 + k, words(150, 9)) for k in range(25)]  # copies
    rows += [(300 + k, words(150, 10).replace("w000", f"n{k}", 1)) for k in range(25)]
    return rows


def documents(spark, rows=None):
    rows = odd_texts() if rows is None else rows
    return spark.createDataFrame([
        (i, text, "en", None if n % 7 == 0 else f"s{n % 3}", None if text is None else len(text),
         "k", "x", "1", "d", "_", "@", "gg")
        for n, (i, text) in enumerate(rows)
    ], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")
