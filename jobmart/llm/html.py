"""Main text of HTML pages from streaming parser events.

The standard library's parser is fed the page and its events are folded into lines, one per block, with
the characters of text and the number of tags met while the line was open. The text-to-tag ratio per line is
smoothed by a Gaussian, and lines above a threshold (a share of the ratios' standard deviation) form
clusters. Every cluster selects a content region: the innermost article or main element around it or, where
there is neither, the innermost element holding the cluster. Lines of a cluster beside an article or main are
regions of their own where their own ratio is above the threshold. Regions are returned whole and in page
order, short paragraphs and headings included, without the parts that are never content (navigation, page
headers and footers, asides, forms, notices, adverts, comments, scripts and styles, recognised by tag, role,
class or id).

Every page is one call on its own row: no shuffle, time and memory linear in the page, however deep its elements.
Elements are numbered in page order, so an element's descendants are a range of numbers. Defined results: null or empty
html, and pages without content, give an empty text; repeated rows are extracted each on its own; an
empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame

SIGMA, SHARE = 2.0, 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
SKIP = frozenset("aside button dialog footer form head iframe input menu nav noscript object script select style svg template textarea title".split())
HOLDERS = frozenset(("article", "main"))
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
_WORDS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer masthead menu modal nav navbar "
                   "navigation newsletter notice notices pagination popup promo promoted related share sharing sidebar social sponsor sponsored subscribe widget".split())
_COMMENTS = frozenset(("comment", "comments"))
#: Words that name no content wherever they stand; the others may, inside an article.
_SURE = frozenset("ad ads advert advertisement adverts breadcrumb breadcrumbs comment comments consent cookie cookies disqus modal navbar pagination popup sponsored".split())
#: What stands beside such a word in a compound name.
_PARTS = frozenset("area bar bottom box block button buttons container content form global header icons inline inner items left line links list main menu message overlay page panel post "
                   "posts primary right row section site slot text thread top unit wrap wrapper zone".split())
_SPLIT = re.compile(r"[^a-z]+")


def _names(value: str, words: frozenset) -> bool:
    """Whether a class or id is made of one of the words, alone or with parts that name furniture."""
    for name in value.split():
        parts = [p for p in _SPLIT.split(name) if p]
        if any(p in words for p in parts) and all(p in words or p in _WORDS or p in _PARTS for p in parts):
            return True
    return False


#: An open paragraph ends where one of these starts; the others end at their own kind.
_CLOSES_P = BLOCKS - {"html", "body"}
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_SPACE = re.compile(r"\s+")


class Lines(HTMLParser):
    """Folds parser events into lines: (text, tags, number of the innermost open element).

    ``last[n]`` is the highest number inside element ``n``, ``parent[n]`` the element around it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.open, self.parts, self.tags, self.skip = [], [], [], 0, 0
        self.parent, self.last = [0], [0]  # element 0 is the page
        self.holders: set[int] = set()
        self.counts: Counter[str] = Counter()  # open elements by tag
        self.links = 0
        self.suspects: dict[int, list[int]] = {}  # element: [letters, letters in links]
        self.watched: list[int] = []  # open suspects

    def _end_line(self):
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.lines.append((text, self.tags, self.open[-1][2] if self.open else 0))
                self.tags = 0
            self.parts = []

    def _in_holder(self) -> bool:
        return any(self.counts[t] for t in HOLDERS)

    def _unwanted(self, tag, attrs) -> tuple[bool, bool]:
        """Whether an element is never content, and whether it is only suspected of it."""
        inside = self._in_holder()
        if tag in SKIP or tag == "header" and not inside:
            return True, False
        suspect = False
        for name, value in attrs:
            value = (value or "").lower()
            if name in ("class", "id") and tag not in ("body", "html"):
                if _names(value, _COMMENTS if tag in HOLDERS else _SURE if inside else _WORDS):
                    return True, False
                suspect = suspect or inside and tag not in HOLDERS and _names(value, _WORDS)
            if name == "role" and value in _ROLES or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                return True, False
        return False, suspect

    def _pop(self, at: int):
        while len(self.open) > at:
            tag, unwanted, number = self.open.pop()
            self.skip -= unwanted
            self.counts[tag] -= 1
            self.links -= tag == "a"
            self.last[number] = len(self.parent) - 1
            if self.watched and self.watched[-1] == number:
                self.watched.pop()
                for around in self.watched[-1:]:  # the suspect around it has these letters too
                    for i in (0, 1):
                        self.suspects[around][i] += self.suspects[number][i]

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.parts.append(" ")
            self.tags += 1
            return
        if tag in BLOCKS:
            self._end_line()
        self.tags += 1
        if tag in VOID:
            return
        ends = ("p",) if tag in _CLOSES_P else ()
        ends += _SAME.get(tag, ())
        if any(self.counts[t] for t in ends):
            for i in range(len(self.open) - 1, -1, -1):
                t = self.open[i][0]
                if t in ends:
                    self._pop(i)
                    break
                if t in BLOCKS and t != "p":
                    break
        unwanted, suspect = self._unwanted(tag, attrs)
        number = len(self.parent)
        self.parent.append(self.open[-1][2] if self.open else 0)
        self.last.append(number)
        self.open.append((tag, unwanted, number))
        self.skip += unwanted
        self.counts[tag] += 1
        self.links += tag == "a"
        if suspect:
            self.suspects[number] = [0, 0]
            self.watched.append(number)
        if tag in HOLDERS:
            self.holders.add(number)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag != "br":
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if not self.counts[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                if any(self.open[j][0] in BLOCKS for j in range(i, len(self.open))):
                    self._end_line()
                self._pop(i)
                return

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)
            if self.watched:
                letters = len(data) - data.count(" ")
                self.suspects[self.watched[-1]][0] += letters
                self.suspects[self.watched[-1]][1] += letters * (self.links > 0)

    def close(self):
        super().close()
        self._end_line()
        self._pop(0)
        self.last[0] = len(self.parent) - 1
        gone = _Ranges(self.last)
        for number, (letters, linked) in self.suspects.items():
            if 2 * linked >= letters:
                gone.add(number)
        if gone.starts:
            self.lines = [x for x in self.lines if x[2] not in gone]


class _Ranges:
    """Elements with all they hold, as ranges of numbers that do not overlap."""

    def __init__(self, last: list[int]):
        self.last, self.starts = last, []

    def __contains__(self, number: int) -> bool:
        i = bisect_right(self.starts, number) - 1
        return i >= 0 and number <= self.last[self.starts[i]]

    def add(self, number: int) -> None:
        if number not in self:
            a, b = bisect_left(self.starts, number), bisect_right(self.starts, self.last[number])
            self.starts[a:b] = [number]  # those inside it go


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    reach = int(math.ceil(3 * sigma))
    kernel = [math.exp(-(i * i) / (2 * sigma * sigma)) for i in range(-reach, reach + 1)]
    total = sum(kernel)
    n = len(values)
    return [sum(k * values[min(max(i + j - reach, 0), n - 1)] for j, k in enumerate(kernel)) / total for i in range(n)]


class Page:
    """The lines and elements of a parsed page, with what the selection asks of them."""

    def __init__(self, parser: Lines):
        self.lines, self.parent, self.last, self.holders = parser.lines, parser.parent, parser.last, parser.holders
        self.holder = [0] * len(self.parent)  # the innermost article or main around each element, itself included
        for n in range(1, len(self.parent)):
            self.holder[n] = n if n in self.holders else self.holder[self.parent[n]]
        self.used = sorted({h for _, _, n in self.lines if (h := self.holder[n])})

    def holds_holder(self, n: int) -> bool:
        """Whether an article or main with lines of its own lies inside an element."""
        return bisect_right(self.used, self.last[n]) > bisect_right(self.used, n)

    def root(self, at: range) -> int | None:
        """The innermost holder of most of these lines' text, or the innermost element around all of them."""
        weight: Counter[int] = Counter()
        for i in at:
            if h := self.holder[self.lines[i][2]]:
                weight[h] += len(self.lines[i][0])
        total = sum(len(self.lines[i][0]) for i in at)
        for h in sorted(weight, reverse=True):
            up = h  # a holder also has the text of those inside it
            while (up := self.holder[self.parent[up]]) and up not in weight:
                weight[up] = 0
        for h in sorted(weight, reverse=True):
            if 2 * weight[h] >= total:
                return h
            if up := self.holder[self.parent[h]]:
                weight[up] += weight[h]
        common = self.lines[at.start][2]
        for i in at:
            while not common <= self.lines[i][2] <= self.last[common]:
                common = self.parent[common]
        if len(at) == 1 and common and self.parent[common]:
            return self.parent[common]
        return common or None


def content(page: Page, sigma: float = SIGMA, share: float = SHARE) -> list[str]:
    """The lines of the regions that the clusters select, in page order."""
    lines = page.lines
    if not lines:
        return []
    own = [len(text) / max(tags, 1) for text, tags, _ in lines]
    ratio = smoothed(own, sigma)
    mean = sum(ratio) / len(ratio)
    limit = share * math.sqrt(sum((x - mean) ** 2 for x in ratio) / len(ratio))
    clusters, at = [], None
    for i, x in enumerate([*ratio, -1.0]):
        if x >= limit:
            at = i if at is None else at
        elif at is not None:
            clusters.append(range(at, i))
            at = None
    # the cluster with the most text, the first of equals, selects its region whole
    best = max(clusters, key=lambda c: sum(len(lines[i][0]) for i in c))
    first = page.root(best)
    if first is None:
        return [text for text, _, _ in lines]
    roots, single = _Ranges(page.last), set()
    roots.add(first)
    kept = lambda i: i in single or lines[i][2] in roots
    # the other clusters, and what the best one holds besides, add theirs; an element around an article or main is not taken for lines beside it
    for c in clusters:
        i = c.start
        while i < c.stop:
            if kept(i):
                i += 1
                continue
            a, holder = i, page.holder[lines[i][2]]
            while i < c.stop and not kept(i) and page.holder[lines[i][2]] == holder:
                i += 1
            b = i
            if (a, b) != (c.start, c.stop):
                # beside another region smoothing reaches over the edge: the lines' own ratios decide
                strong = [j for j in range(a, b) if own[j] >= limit]
                if not strong:
                    continue
                a, b = strong[0], strong[-1] + 1
            root = holder or page.root(range(a, b))
            if root is None or root not in page.holders and page.holds_holder(root):
                single.update(range(a, b))
            else:
                roots.add(root)
    return [text for i, (text, _, _) in enumerate(lines) if kept(i)]


def main_text(html: str) -> str:
    parser = Lines()
    parser.feed(html)
    parser.close()
    return "\n\n".join(content(Page(parser)))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: its id, url, main text and the text's length."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                texts = [main_text(h.as_py() or "") for h in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(pages["page_id"].cast("bigint"), pages["url"].cast("string"), pages["html"].cast("string")).mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")
