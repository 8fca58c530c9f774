"""Main text of web pages: text-to-tag ratios of parser events, smoothed and clustered.

A page is read as a stream of events of the standard library's parser and cut into
lines, one per block of markup. A line has its text, the tags opened in it and the
region it stands in (an article, the main part, or the innermost division). The ratio of
characters to tags is smoothed over the lines with a Gaussian window; lines above the
standard deviation of the smoothed ratios are content. The articles and main parts that
hold content are the main text; where a page has none of them, all regions that are mostly
content. Within these every line counts, short ones too, but for runs of links below the
threshold.

What markup declares as something else never counts: navigation, page headers and
footers, asides, forms, scripts, styles, and elements whose class, id or role says menu,
advert, notice, comments and the like. Within an article a header keeps its headings.

Nulls, ties and odd rows: null or empty html, or a page without content, gives an empty
text. Markup that is not closed ends with the element around it, and an element that
opens the article ends what was left open before. Of regions with equal content the
first counts. Extra columns are passed over, rows that repeat have the same result each,
an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Lines on each side that a ratio is smoothed over, and the width of the window.
REACH, SIGMA = 3, 1.5

#: Elements whose text is never part of the main text.
OTHER = frozenset(
    "head title script style noscript template nav footer aside form button select option "
    "textarea iframe object svg canvas audio video dialog menu datalist".split()
)

#: Elements without content, and elements that do not end a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)

#: Elements that end an open one of the same kind.
ENDS = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}

#: Elements that end an open paragraph.
_ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
    "main nav ol p pre section table ul".split()
)

#: Elements that an end tag of an element around them does not reach over.
_REGIONS = frozenset("article main section div td body".split())

#: Words in a class, id or role that name something beside the main text.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo "
    "promos promotion banner banners sidebar sidebars nav navbar navigation navigations menu menus "
    "topbar breadcrumb breadcrumbs masthead footer foot colophon copyright comment comments "
    "commentlist disqus reply replies respond discussion cookie cookies consent gdpr notice "
    "notices notification notifications alert popup modal overlay newsletter subscribe "
    "subscription signup signin login share sharing social related recommended recommendations "
    "widget widgets toolbar pagination pager search complementary contentinfo skip "
    "disclaimer paywall teaser teasers trending".split()
)
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog menu menubar".split()
)
_WRAPPERS = frozenset("content main wrap wrapper container page layout has with no".split())
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _named_other(tag: str, attrs: dict, within: bool) -> bool:
    """Whether an element's attributes say that it is beside the main text.

    Within an article or main part the names of headings and inline elements do not count.
    """
    if tag in ("html", "body"):
        return False
    if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
        return True
    if _HIDDEN.search(attrs.get("style") or ""):
        return True
    if (attrs.get("role") or "").lower() in _ROLES:
        return True
    if within and (tag in INLINE or tag in _HEADINGS):
        return False
    for value in ((attrs.get("class") or "").split() + (attrs.get("id") or "").split()):
        words = {word.lower() for word in _TOKENS.findall(value)}
        if words & NAMES and not words & _WRAPPERS:
            return True
        if "header" in words and tag != "article" and not words & (
            _WRAPPERS | {"article", "entry", "post", "section"}
        ):
            return True
    return False


class Lines(HTMLParser):
    """Lines of a page: text, tags, characters in links, region, whether it can count."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.kinds: list[str] = ["page"]
        self._open: list[tuple[str, int, bool]] = []  # element, region, beside the text
        self._text: list[str] = []
        self._tags = self._linked = self._links = 0
        self._article = False
        self._named: Counter[str] = Counter()  # open elements of each kind
        self._within = 0  # open elements in an article or main part

    def _state(self) -> tuple[int, bool]:
        return self._open[-1][1:] if self._open else (0, False)

    def _end_line(self):
        text = " ".join("".join(self._text).split())
        if text:
            self.lines.append((text, self._tags, self._linked, self._state()[0]))
            self._tags = 0
        self._text, self._linked = [], 0

    def handle_starttag(self, tag, attrs):
        block = tag not in INLINE
        if block:
            self._end_line()
        self._tags += 1
        if tag in VOID:
            return
        if tag in _ENDS_P:
            self._close({"p"})
        if tag in ENDS:
            self._close(ENDS[tag])
        named = _named_other(tag, dict(attrs), self._within > 0)
        region, beside = self._state()
        if tag in ("article", "main") and not named and not self._article:
            # What was left open before the article does not hold it.
            beside, self._article = False, True
        within = self._within > 0
        if tag == "header":
            beside = beside or not within or named
            if within and not beside:
                self._push(tag, region, True)
                return
        elif tag in _HEADINGS and self._open and self._open[-1][0] == "header" and within:
            beside = any(b for t, _, b in self._open if t != "header")
        else:
            beside = beside or named or tag in OTHER
        if tag in _REGIONS and not beside:
            kind = tag if tag in ("article", "main") else "part"
            if kind != "part" or self.kinds[region] not in ("article", "main", "inner"):
                self.kinds.append(kind)
                region = len(self.kinds) - 1
        if tag == "a":
            self._links += 1
        self._push(tag, region, beside)

    def _push(self, tag, region, beside):
        self._open.append((tag, region, beside))
        self._named[tag] += 1
        self._within += self.kinds[region] in ("article", "main")

    def _close(self, tags, over=_REGIONS):
        """Close the innermost open element of ``tags``, but no element around a region."""
        if not any(self._named[tag] for tag in tags):
            return
        for k in range(len(self._open) - 1, -1, -1):
            if self._open[k][0] in tags:
                self._pop(k)
                return
            if self._open[k][0] in over:
                return

    def _pop(self, k):
        for tag, region, _ in self._open[k:]:
            self._links -= tag == "a"
            self._named[tag] -= 1
            self._within -= self.kinds[region] in ("article", "main")
        del self._open[k:]

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self._end_line()
        self._close({tag}, over=frozenset() if tag in _REGIONS else _REGIONS - {tag})

    def handle_startendtag(self, tag, attrs):
        if tag not in INLINE:
            self._end_line()
        self._tags += 1

    def handle_data(self, data):
        if self._state()[1]:
            return
        self._text.append(data)
        if self._links:
            self._linked += len(data.strip())

    def close(self):
        super().close()
        self._end_line()


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Ratios under a Gaussian window; at the ends the window is cut."""
    steps = np.arange(-REACH, REACH + 1)
    window = np.exp(-(steps**2) / (2 * SIGMA**2))
    total = np.convolve(ratios, window, "full")[REACH:REACH + ratios.size]
    weight = np.convolve(np.ones(ratios.size), window, "full")[REACH:REACH + ratios.size]
    return total / weight


def main_text(html: str | None) -> str:
    """The main text of a page."""
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    sizes = np.array([len(line[0]) for line in lines], np.float64)
    ratio = smoothed(sizes / np.maximum(1, [line[1] for line in lines]))
    content = ratio >= min(ratio.std(), ratio.max())
    region = np.array([line[3] for line in lines])
    linked = np.array([line[2] for line in lines]) > 0.8 * sizes

    score = np.bincount(region, ratio * sizes * content, len(parser.kinds))
    chosen = np.zeros(len(parser.kinds), bool)
    own = np.array([kind in ("article", "main") for kind in parser.kinds])
    present = own & (np.bincount(region, minlength=own.size) > 0)
    if present.any():
        # The best one, and all others that hold content.
        chosen = present & (score > 0)
        chosen[np.argmax(np.where(present, score + 1, 0))] = True
    else:
        size = np.bincount(region, sizes, len(parser.kinds))
        inside = np.bincount(region, sizes * content, len(parser.kinds))
        chosen = (size > 0) & (inside >= 0.5 * size)
    kept = chosen[region]
    # Three link lines on end, below the threshold, are a menu that is not marked as one.
    menu = kept & linked & ~content
    edge = np.flatnonzero(np.diff(np.concatenate(([0], menu.astype(np.int8), [0]))))
    for a, b in zip(edge[::2], edge[1::2]):
        if b - a >= 3:
            kept[a:b] = False
    return " ".join(line[0] for line, keep in zip(lines, kept) if keep)


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(html) for html in batch["html"]]
            yield pd.DataFrame({
                "page_id": batch["page_id"], "url": batch["url"], "text": texts,
                "n_chars": [len(text) for text in texts],
            })

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInPandas(
        run, f"page_id {kind}, url string, text string, n_chars long"
    )
