"""Texts as chunks that tokenizers treat apart, so that a chunk seen before costs nothing.

A chunk ends before a lone blank: a space between two characters that are no white space.
Byte-level BPE splits its input there in any case, and a sentencepiece vocabulary without
a space inside a piece never merges across it, so the tokens of a text are those of its
chunks, one after the other (``tests/llm/test_tokens.py`` compares both on odd texts).
Every chunk but the first has that space in front of it; it is left out here.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

_LONE = re.compile(r" (?<=\S )(?=\S)")

#: Results kept by a worker, and the longest chunk that is kept. They change time and memory
#: only: a result that is gone is made again.
KEPT, LONGEST = 1_000_000, 64

#: Characters of a text that are looked at together.
WINDOW = 1 << 20


def windows(text: str, size: int = WINDOW) -> Iterator[list[str]]:
    """The chunks of a text, in lists that stand for about ``size`` characters each."""
    at = 0
    while len(text) - at > size:
        cut = _LONE.search(text, at + size)
        if cut is None:
            break
        yield _LONE.split(text[at:cut.start()])
        at = cut.end()
    yield _LONE.split(text[at:] if at else text)


class Known(dict):
    """Results of ``make`` on single chunks, the latest ones kept.

    Results are kept in two halves; when the younger one is full the older is dropped, so
    that chunks in use stay.
    """

    def __init__(self, make: Callable[[str], object], kept: int = KEPT):
        super().__init__()
        self._make, self._half, self._old = make, kept // 2, {}

    def __missing__(self, chunk: str):
        found = self._old.get(chunk)
        if found is None:
            found = self._make(chunk)
        if len(chunk) <= LONGEST:
            if len(self) >= self._half:
                self._old = dict(self)
                self.clear()
            self[chunk] = found
        return found

    def of(self, chunks: list[str]) -> list:
        return [*map(self.__getitem__, chunks)]
