"""Noisy-channel reading of disguised words: leetspeak, spacing and repeated letters.

A disguised stretch of text is a lattice: at every character some readings, each with a
cost for the disguise. A sign can stand for letters it looks like, a separator between
letters can be dropped, a run of one letter can be shorter, and between letters that
were spaced out a word can end. The reading with the least cost plus the least surprise
under a language model of characters is found by the Viterbi algorithm, whose states are
the last letters read.
"""

from __future__ import annotations

import math
import re
import unicodedata

#: Letters of a context, and the symbol for any letter beyond a to z.
ORDER, OTHER = 3, "~"

#: Letters that a sign can stand for (fixed values of the channel).
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou",
    "€": "e", "£": "l", "¡": "i", "¢": "c", "#": "h",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "к": "k",
    "ѕ": "s", "т": "t", "м": "m", "н": "h", "в": "b",
}

#: Letters that a sign can sound like.
SOUNDS = {"8": "ate"}

#: Costs of the channel: a sign for a letter, a letter less in a run of three or more or
#: of two, a separator dropped, another sign dropped, a word's end between spaced letters.
SIGN, LONG_RUN, PAIR, SEPARATOR, DROPPED, END = 0.7, 0.4, 6.0, 0.4, 6.0, 3.0

SEPARATORS = frozenset(" .-_*'~,·/\n\r\t")
#: Characters that do not show.
_HIDDEN = "\u200b\u200c\u200d\u2060\ufeff\u00ad"

#: What may be disguised: signs beside letters (at a word's end no exclamation mark and no
#: run of three), runs of letters, letters that are spaced out, separators within a word.
_SIGNS = r"0-9@$!|+*(€£¡¢#а-яіѕ"
_BETWEEN = r"[ .\-_*'~,·/\n\r\t]"
_FOUND = re.compile(
    rf"(?<!\S)[{_SIGNS}]+[a-z]|[a-z][{_SIGNS}]+[a-z]|[a-z][-._*'~·,/][a-z]"
    rf"|[a-z](?!!|(?P<one>[{_SIGNS}])(?P=one){{2}})[{_SIGNS}]+[.,;:?\"')\]}}>&%]*(?!\S)"
    rf"|(?P<run>[a-z])(?P=run){{2}}"
    rf"|(?<!\S)[^\W_](?:{_BETWEEN}{{1,2}}[^\W_{_SIGNS}0-9]|{_BETWEEN}{{1,2}}[{_SIGNS}]){{2,}}(?!\S\S)"
)
_BLANK = re.compile(r"\s")
_WORDS = re.compile(r"[^\W\d_]+")


class Letters:
    """A model of letters in words: counts of runs of up to ``ORDER + 1`` letters."""

    def __init__(self, counts: dict[str, int]):
        """``counts`` has runs of letters; ``^`` is before a word, ``$`` after it."""
        self._runs: dict[str, float] = {}
        self._contexts: dict[str, float] = {}
        for run, n in counts.items():
            for k in range(len(run)):
                part = run[k:]
                self._runs[part] = self._runs.get(part, 0) + n
                self._contexts[part[:-1]] = self._contexts.get(part[:-1], 0) + n
        self._known: dict[tuple[str, str], float] = {}

    def cost(self, context: str, letter: str) -> float:
        """Minus the logarithm of the probability of a letter after a context."""
        key = (context, letter)
        found = self._known.get(key)
        if found is None:
            p = 1 / 64
            for k in range(len(context) + 1):
                tail = context[len(context) - k:]
                n = self._contexts.get(tail, 0)
                p = (self._runs.get(tail + letter, 0) + 4 * p) / (n + 4)
            found = self._known[key] = -math.log(p)
        return found


def word_runs(word: str) -> list[str]:
    """Runs of letters of a word with its ends, the counts of which make a model."""
    plain = "^" * ORDER + "".join(c if "a" <= c <= "z" else OTHER for c in word) + "$"
    return [plain[k:k + ORDER + 1] for k in range(len(plain) - ORDER)]


def readings(stretch: str) -> list[tuple[int, int, str, float]]:
    """The lattice: from place, to place, letters read (``$`` ends a word), cost."""
    edges = []
    spaced = len(re.findall(_BETWEEN, stretch)) >= len(stretch) // 2 - 1 and len(stretch) > 4
    k, size = 0, len(stretch)
    while k < size:
        c = stretch[k]
        end = k + 1
        while end < size and stretch[end] == c:
            end += 1
        run = end - k
        if c.isalpha() and c not in LOOKS:
            drop = LONG_RUN if run > 2 else PAIR
            # A run is read once, twice or as it is.
            for many in {1, min(run, 2), run}:
                edges.append((k, end, c * many, drop if many < run else 0.0))
        else:
            for looks in LOOKS.get(c, ""):
                edges.append((k, end, looks, SIGN + (0, 3.0, LONG_RUN)[min(run, 3) - 1]))
                if run == 2:
                    edges.append((k, end, looks * 2, 2 * SIGN))
            if c in SOUNDS and run == 1:
                edges.append((k, end, SOUNDS[c], SIGN))
            edges.append((k, end, "", SEPARATOR if c in SEPARATORS else DROPPED))
            if c in SEPARATORS:
                edges.append((k, end, "$", END if spaced else SEPARATOR))
        k = end
    return edges


def decoded(stretch: str, letters: Letters) -> list[str]:
    """The words of the likeliest reading of a stretch."""
    size = len(stretch)
    begin = "^" * ORDER
    # Per place: the last letters read, their cost, and how they were reached.
    best: list[dict[str, tuple[float, tuple | None, str]]] = [{} for _ in range(size + 1)]
    best[0][begin] = (0.0, None, "")
    for start, end, read, price in readings(stretch):
        here, there = best[start], best[end]
        for context, (cost, _, _) in here.items():
            total, now = cost + price, context
            if read == "$":
                if context != begin:
                    total += letters.cost(context, "$")
                now = begin
            else:
                for letter in read:
                    letter = letter if "a" <= letter <= "z" else OTHER
                    total += letters.cost(now, letter)
                    now = (now + letter)[-ORDER:]
            held = there.get(now)
            if held is None or total < held[0]:
                there[now] = (total, (start, context), read)
    ends = {
        context: found[0] + (letters.cost(context, "$") if context != begin else 0.0)
        for context, found in best[size].items()
    }
    if not ends:
        return []
    place, context, parts = size, min(ends, key=lambda c: (ends[c], c)), []
    while place or context != begin:
        _, back, read = best[place][context]
        parts.append(read)
        if back is None:
            break
        place, context = back
    return "".join(reversed(parts)).replace("$", " ").split()


#: Stretches remembered by a worker with their readings.
REMEMBERED = 100_000


def restored(text: str, letters: Letters, known: dict[str, list[str]]) -> set[str]:
    """The distinct words of a text in lower case, and those that its disguises read as."""
    plain = text if text.isascii() else unicodedata.normalize("NFKC", text)
    for hidden in _HIDDEN:
        if hidden in plain:
            plain = plain.replace(hidden, "")
    plain = plain.lower()
    words = set(_WORDS.findall(plain))
    done = 0
    for found in _FOUND.finditer(plain):
        if found.start() < done:
            continue
        # The stretch reaches to the white space around what was found.
        start = max(plain.rfind(" ", 0, found.start() + 1), plain.rfind("\n", 0, found.start() + 1),
                    plain.rfind("\t", 0, found.start() + 1)) + 1
        after = _BLANK.search(plain, found.end())
        done = after.start() if after else len(plain)
        stretch = plain[start:done].strip(".,;:?\"')]}>&%")
        stretch = re.sub(r"([^\w\s])\1\1+$|([^\w\s$@€£¢])\2$|!+$", "", stretch)
        have = known.get(stretch)
        if have is None:
            if len(known) >= REMEMBERED:
                known.clear()
            have = known[stretch] = decoded(stretch, letters)
        words.update(have)
    return words
