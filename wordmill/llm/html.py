"""Main text of web pages by text-to-tag ratios over streamed parser events.

The standard library's parser is fed a page in pieces; its events make *lines*: stretches of text
between block elements, each with the tags that stand in it. The ratio of letters to tags of the
lines, smoothed with a Gaussian, is high in articles and low in menus; a threshold that splits the
smoothed ratios into two clusters marks the dense lines. The content region is the smallest element
that holds most of the dense letters, widened to an ``article`` or ``main`` around it and to parents whose
further lines are dense too; its lines are the text, without elements whose name, role or class
says that they are no article. A class name says so by its words, if all others in it are of layout (``ad-slot``,
``comment-list``, but not ``has-sidebar``), and not of an element that holds an ``article``, a ``main`` or most of
the dense letters. Elements know their parent, and sums go from children to parents, so the time follows the length
of a page however deep it nests.

Defined results: a null or empty page has no text; unclosed, misnested and cut-off markup is read
as far as it goes; a page without any dense line gives the lines of its body. Rows are neither
joined nor grouped; other columns are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wordmill.llm.common import map_rows, texts

FEED = 1 << 16  # characters given to the parser at once
SIGMA = 1.0  # of the Gaussian, in lines
REACH = 3
SHARE = 0.6  # of the dense letters that the content region holds

# Names of HTML elements.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table"
    " tbody td tfoot th thead title tr ul".split()
)
# No text of an article, whatever they hold.
SILENT = frozenset(
    "script style noscript template iframe object embed applet canvas svg math audio video map select datalist"
    " textarea button input form head title nav footer aside dialog menu noframes".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that end when another of their kind begins, or a block around them ends.
IMPLIED = {"p": BLOCKS - {"p"} | {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
_SILENT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
# Words of class and id values that name what is no article.
_SILENT_WORDS = frozenset(
    "ad ads advert advertisement advertising adsense sponsor sponsored promo promotion banner popup modal cookie"
    " cookies consent gdpr notice newsletter subscribe subscription signup login nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar widget footer header masthead comment comments disqus respond reply share"
    " sharing social related recommended pagination pager copyright".split()
)
# Words that say only where or how the others stand, and those that say whose replies they are.
_LAYOUT_WORDS = frozenset(
    "area bar block body bottom box button buttons center col column container content count feed group icon icons id"
    " inner inline item items left link links list main module outer panel right row section site slot sticky text"
    " thread title top unit wrap wrapper zone".split()
)
_OWNERS = frozenset("all article disqus entry facebook fb post reader readers single user users view wp".split())
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_CUT_TAG = re.compile(r"<[A-Za-z/!?]")
_KEEP = frozenset(("article", "main", "body", "html"))
# Of readers: often more than the article, and often articles themselves.
_REPLIES = frozenset("comment comments disqus respond reply".split())


def _names(attrs: dict[str, str | None]) -> list[list[str]]:
    """The words of each name in class and id values."""
    named = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
    return [[w.lower() for w in _WORDS.findall(n)] for n in named]


def _says_no_article(words: list[str]) -> bool:
    others = set(words) - _SILENT_WORDS
    if len(others) == len(set(words)):
        return False
    return others <= (_LAYOUT_WORDS if _REPLIES.isdisjoint(words) else _LAYOUT_WORDS | _OWNERS)


class _Line:
    __slots__ = ("at", "silent", "tags", "text")

    def __init__(self, at: int, silent: bool) -> None:
        self.at, self.silent, self.tags, self.text = at, silent, 0, []


class LineParser(HTMLParser):
    """Lines of a page, each with the innermost element around it (by number) and whether that is silent."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.open: list[tuple[str, int, bool]] = []  # name, number, silent
        self.many: Counter[str] = Counter()  # open elements by name
        self.stops: list[int] = []  # places in ``open`` of blocks, and of what another element may end
        self.names: list[str] = [""]  # of the elements, by number
        self.parents: list[int] = [0]
        self.doubted: dict[int, bool] = {}  # elements that a class silences; whether they are readers' replies
        self.marks: set[int] = set()  # article and main elements that are no reply
        self._begin()

    def _begin(self) -> None:
        _, number, silent = self.open[-1] if self.open else ("", 0, False)
        self.line = _Line(number, silent)
        self.lines.append(self.line)

    def _close(self, name: str) -> None:
        """Ends the innermost open ``name`` and what is open inside of it."""
        if not self.many[name]:
            return
        changed, ended = False, ""
        while ended != name:
            ended = self.open.pop()[0]
            self.many[ended] -= 1
            changed = changed or ended in BLOCKS or ended in SILENT
        while self.stops and self.stops[-1] >= len(self.open):
            self.stops.pop()
        if changed:
            self._begin()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.line.tags += 1
        if tag in VOID:
            if tag in ("br", "hr"):
                self.line.text.append("\n")
            return
        for i in reversed(self.stops):
            name = self.open[i][0]
            if name in IMPLIED and tag in IMPLIED[name]:
                self._close(name)
                break
            if name in BLOCKS:
                break
        named = dict(attrs)
        silent = bool(self.open) and self.open[-1][2] or tag in SILENT or self._is_silent(tag, named)
        if not silent:
            self._doubt(tag, _names(named))
        if tag in BLOCKS or tag in IMPLIED:
            self.stops.append(len(self.open))
        self.parents.append(self.open[-1][1] if self.open else 0)
        self.open.append((tag, len(self.names), silent))
        self.many[tag] += 1
        self.names.append(tag)
        if tag in BLOCKS or tag in SILENT:
            self._begin()

    def _doubt(self, tag: str, names: list[list[str]]) -> None:
        number = len(self.names)
        if tag in ("article", "main"):
            if not any(n and n[0] in _REPLIES for n in names):
                self.marks.add(number)
        elif tag in BLOCKS and tag not in _KEEP:
            said = [n for n in names if _says_no_article(n)]
            if said:
                self.doubted[number] = any(not _REPLIES.isdisjoint(n) for n in said)

    def _is_silent(self, tag: str, attrs: dict[str, str | None]) -> bool:
        if tag in _KEEP:
            return False
        if (attrs.get("role") or "").lower() in _SILENT_ROLES or "hidden" in attrs or (attrs.get("aria-hidden") or "") == "true":
            return True
        if tag == "header":  # a header that is no part of an article
            return not self.many["article"]
        return False

    def handle_endtag(self, tag: str) -> None:
        self.line.tags += 1
        if tag not in VOID:
            self._close(tag)

    def handle_data(self, data: str) -> None:
        self.line.text.append(data)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines."""
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)
    return np.convolve(np.pad(ratios, REACH, mode="edge"), kernel / kernel.sum(), mode="valid")


def two_clusters(values: np.ndarray) -> float:
    """The threshold between the two clusters of least spread (of the values' logarithms)."""
    v = np.sort(np.log1p(values))
    if v[0] == v[-1]:
        return -1.0
    left, squares, n = np.cumsum(v), np.cumsum(v * v), np.arange(1, len(v) + 1)
    spread = squares[:-1] - left[:-1] ** 2 / n[:-1] + (squares[-1] - squares[:-1]) - (left[-1] - left[:-1]) ** 2 / (len(v) - n[:-1])
    at = int(spread.argmin())
    return float(np.expm1((v[at] + v[at + 1]) / 2))


def parse_lines(html: str) -> LineParser:
    parser = LineParser()
    for start in range(0, len(html), FEED):
        parser.feed(html[start : start + FEED])
    if _CUT_TAG.match(parser.rawdata):  # a tag or comment that the page's end cuts off
        parser.rawdata = ""
    parser.close()
    return parser


def dense_lines(every: list[tuple[_Line, str]]) -> list[bool]:
    # Ratios over every line that has text; silent ones count as markup.
    ratio = smoothed(np.array([0.0 if line.silent else len(text) / max(1, line.tags) for line, text in every]))
    limit = two_clusters(ratio)
    return [bool(r > limit) and not line.silent for (line, _), r in zip(every, ratio, strict=True)]


def _sums(values: list[int], parents: list[int]) -> list[int]:
    """Sums over each element and all inside of it; children have higher numbers."""
    for e in range(len(values) - 1, 0, -1):
        values[parents[e]] += values[e]
    return values


def _inside(chosen: set[int], parents: list[int]) -> list[bool]:
    """Whether each element is one of ``chosen`` or inside of one."""
    found = [0 in chosen]
    for e in range(1, len(parents)):
        found.append(e in chosen or found[parents[e]])
    return found


def silence_by_class(every: list[tuple[_Line, str]], parser: LineParser) -> None:
    """Silences the lines of the doubted elements that hold no article, no main and not most of the
    dense letters; replies hold no article unless nothing outside of doubted elements is dense."""
    doubted, parents = parser.doubted, parser.parents
    within = _inside(set(doubted), parents)
    dense, spoken = [0] * len(parents), [0] * len(parents)
    plain = 0
    for (line, text), is_dense in zip(every, dense_lines(every), strict=True):
        dense[line.at] += len(text) * is_dense
        spoken[line.at] += not line.silent
        plain += 0 if within[line.at] else len(text) * is_dense
    dense, spoken = _sums(dense, parents), _sums(spoken, parents)
    marked = _sums([int(e in parser.marks and spoken[e] > 0) for e in range(len(parents))], parents)
    silent = {
        e for e, replies in doubted.items()
        if marked[e] == (e in parser.marks and spoken[e] > 0) and (2 * dense[e] <= dense[0] or replies and plain > 0)
    }
    muted = _inside(silent, parents)
    for line, _ in every:
        line.silent = line.silent or muted[line.at]


def content_region(lines: list[tuple[_Line, str, bool]], parser: LineParser) -> int | None:
    """The element that holds the article, of lines ``(line, text, dense)`` that are not silent."""
    names, parents = parser.names, parser.parents
    dense, letters, blocks = ([0] * len(names) for _ in range(3))
    for line, text, is_dense in lines:
        dense[line.at] += len(text) * is_dense
        letters[line.at] += len(text)
        blocks[line.at] += 1
    dense, letters, blocks = (_sums(v, parents) for v in (dense, letters, blocks))
    # Numbers grow inwards: the last one that holds enough is the smallest. One block is no region.
    wide = (e for e in range(len(names) - 1, 0, -1) if blocks[e] > 1 or blocks[e] and names[e] in ("article", "main"))
    region = next((e for e in wide if dense[0] and dense[e] >= SHARE * dense[0]), None)
    if region is None:
        return None
    around = region
    while around:
        if names[around] in ("article", "main"):
            return around
        around = parents[around]
    while parent := parents[region]:
        more = letters[parent] - letters[region]
        if 2 * (dense[parent] - dense[region]) < more:
            break
        region = parent
    return region


def main_text(html: str) -> str:
    """The article of a page: its blocks in page order, an empty line between them."""
    parser = parse_lines(html)
    every = [(line, text) for line in parser.lines if (text := " ".join("".join(line.text).split()))]
    if all(line.silent for line, _ in every):
        return ""
    if parser.doubted:
        silence_by_class(every, parser)
        if all(line.silent for line, _ in every):
            return ""
    spoken = [(line, text, dense) for (line, text), dense in zip(every, dense_lines(every), strict=True) if not line.silent]
    region = content_region(spoken, parser)
    held = _inside({region or 0}, parser.parents)
    return "\n\n".join(text for line, text, _ in spoken if held[line.at])


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Per row ``(id, *keep, text, n_chars)``; code points count."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType(
        [pages.schema[id_col], *(pages.schema[c] for c in keep), StructField("text", StringType()), StructField("n_chars", LongType())]
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            found = [main_text(h) for h in texts(part, html_col)]
            yield {id_col: part.column(0), **{c: part.column(2 + i) for i, c in enumerate(keep)}, "text": found, "n_chars": [len(t) for t in found]}

    return map_rows(pages.select(id_col, html_col, *keep), run, schema)
