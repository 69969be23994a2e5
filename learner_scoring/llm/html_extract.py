"""Main text of web pages by the distribution of their line blocks.

Markup is stripped into lines, one per block element. Lines inside menus,
headers, footers, sidebars, notices, adverts, forms and reader comments have no
weight. The weights are summed over a sliding window of lines: a run of lines
surges where a window first holds enough text and dives where it holds none; the
text between is the page's text. Lines inside an ``article`` or ``main`` element
get a bonus of half a surge, so that two such lines surge, however short; a single
one and runs outside surge by their own text. A ``header`` inside an ``article`` is
the article's own (its title and byline); its ``footer`` and ``aside`` are not text
of the article but about it or beside it, and go. Short runs and lines of links alone stay where they share a parent block
with lines that surge; where the heaviest run does not reach a surge, as in
verse, it sets the level. Class, id and role only hint at boilerplate: an element
so marked that holds the page's article or most of its text is none.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learner_scoring.llm.common import arrow_map, ship_by_value

#: Lines of a window, and the text (code points outside links) that makes it a surge.
WINDOW = 3
SURGE = 86
#: Added to the weight of a line with text outside links inside an article or main element; two such lines surge, one does not.
BONUS = 43

#: Elements whose text is markup or data, skipped up to their end tag.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "object", "select", "button"}
#: Elements that hold no article text.
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head"}
MAIN = {"article", "main"}
#: Elements that start and end a block.
BLOCK = ASIDE | MAIN | set(
    "address blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html legend "
    "li ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Blocks that belong to the block around them, and blocks of which that is so where they hold data.
CONTENT = set("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre figure figcaption address caption summary details legend center".split())
TABLE = set("table tbody thead tfoot tr td th".split())
#: Blocks that hold a paragraph or heading of their own.
PARAGRAPH = set("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
#: Elements without an end tag.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that may stay open, closed by the next of their kind.
LOOSE = set("p li dt dd td th tr option".split())
#: Words in class or id that mark boilerplate.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs masthead header footer cookie cookies consent notice notices notification popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations comment comments commentlist respond "
    "replies disqus pagination pager widget toolbar copyright disclaimer".split()
)
#: Of these, words for what is no article text whatever it holds, unless a page has no other text.
NEVER = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent newsletter subscribe "
    "subscription share sharing social related recommended recommendations comment comments commentlist respond replies disqus".split()
)
#: Words before a mark that make it a word about the layout, as in has-sidebar.
ABOUT = {"has", "no", "with", "without"}
#: Words beside a mark that make it a part of the article, as in article-header, and the marks of which that is so.
PARTS = {"article", "post", "entry"}
OWN_PARTS = set("header footer banner masthead notice notices overlay copyright disclaimer".split())
#: ARIA roles that mark boilerplate.
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_HINT = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


#: Kinds of elements: no boilerplate, by its tag, by a hint, by a hint of NEVER.
PLAIN, TAG, HINT, SURE = range(4)


def _marks(value: str) -> set[str]:
    """The words of a class or id that mark its element."""
    out: set[str] = set()
    for one in value.split():
        words = [w.lower() for w in _WORDS.findall(one)]
        part = not PARTS.isdisjoint(words)
        for i, w in enumerate(words):
            if w in MARKS and not (part and w in OWN_PARTS) and ABOUT.isdisjoint(words[:i]):
                out.add(w)
    return out


def _boilerplate(name: str, attrs: str, own: bool) -> int:
    """The kind of an element; ``own``: it is the header of an article."""
    if name in ASIDE and name != "form" and not own:
        return TAG
    kind = HINT if name == "form" else PLAIN
    if name in ("html", "body") or not attrs:
        return kind
    for key, *values in _HINT.findall(attrs):
        value = next((v for v in values if v), "")
        if key.lower() == "role":
            if value.strip().lower() in ROLES:
                kind = max(kind, HINT)
        elif name not in MAIN or "comment" in value.lower():
            words = _marks(value) - (OWN_PARTS if own else set())
            if words:
                kind = max(kind, HINT if words.isdisjoint(NEVER) else SURE)
    return kind


class Line(NamedTuple):
    text: str
    weight: int  # code points outside links
    main: int  # number of its outermost main element, or 0
    own: tuple[int, ...]  # its parent block, by number; also the block itself where the text stands in a div
    near: tuple[int, ...]  # blocks whose text it may belong to
    paragraph: bool


class _Lines:
    """Lines of a page in order; None for a gap of boilerplate."""

    def __init__(self, lifted: set[int] = frozenset()):
        self.lines: list[Line | None] = []
        #: open elements with their numbers; the second is -1 where a tag marks boilerplate, the hint's number where a hint does
        self.stack: list[tuple[str, int, int]] = []
        self.opened = 0
        self.skip = 0
        self.tags = 0
        self.lifted = lifted  # numbers of hints not to be followed
        self.hints = 0
        self.around: dict[int, tuple[int, bool]] = {}  # the hint around a hint or 0, is it or one around it sure
        self.held: dict[int, list[int]] = {}  # text outside links that a hint holds back: all, in articles within
        self.main = 0
        self.mains = 0
        self.link = 0
        self.parts: list[str] = []
        self.linked = 0

    def text(self, raw: str) -> None:
        if self.skip:
            if not self.tags and not self.link and not raw.isspace():
                self._hold(len(raw.strip()))
            return
        s = html.unescape(raw)
        self.parts.append(s)
        if self.link:
            self.linked += len(s)

    def _hold(self, n: int) -> None:
        told = False
        for name, bad, _ in reversed(self.stack):
            if bad:
                held = self.held.setdefault(bad, [0, 0])
                held[0] += n
                held[1] += n * told
                return
            told = told or name in MAIN

    def end_line(self) -> None:
        if self.parts:
            s = " ".join("".join(self.parts).split())
            if s:
                self.lines.append(Line(s, max(0, len(s) - self.linked), self.mains if self.main else 0, *self._blocks()))
        self.parts, self.linked, self.link = [], 0, 0

    def _around(self, at: int, kinds: set[str]) -> int:
        """The number of the block that holds the element at this depth, past elements of these kinds; 0 for the page."""
        while at >= 0 and self.stack[at][0] in kinds:
            at -= 1
        return self.stack[at][2] if at >= 0 else 0

    def _blocks(self) -> tuple[tuple[int, ...], tuple[int, ...], bool]:
        top = len(self.stack) - 1
        inner = self.stack[top][0] if top >= 0 else ""
        own = (self._around(top, CONTENT),)
        if inner in ("div", "section"):
            own += (self._around(top - 1, CONTENT),)
        return own, (*own, self._around(top, CONTENT | TABLE)), inner in PARAGRAPH

    def open(self, name: str, attrs: str) -> None:
        if name == "a":
            self.link += 1
        if name == "br":
            self.text(" ")
        if name in MAIN:  # an unclosed menu or header ends where the article begins
            while self.skip and any(n in ("nav", "header", "footer", "head", "menu") for n, b, _ in self.stack if b):
                self._pop()
        if name == "body":
            while any(n == "head" for n, _, _ in self.stack):
                self._pop()
        if name in BLOCK:
            self.end_line()
        if name in LOOSE and self.stack and self.stack[-1][0] == name:
            self._pop()
        if name in VOID or (name not in BLOCK and name not in MAIN):
            if name not in VOID and (bad := self._bad(name, attrs)):
                self._push(name, bad)
            return
        self._push(name, self._bad(name, attrs))

    def _bad(self, name: str, attrs: str) -> int:
        own = name == "header" and any(n == "article" and not b for n, b, _ in self.stack)
        kind = _boilerplate(name, attrs, own)
        if kind in (PLAIN, TAG):
            return -(kind == TAG)
        self.hints += 1
        if self.hints in self.lifted:
            return 0
        outer = next((b for _, b, _ in reversed(self.stack) if b > 0), 0)
        self.around[self.hints] = (outer, kind == SURE or (outer > 0 and self.around[outer][1]))
        return self.hints

    def _push(self, name: str, bad: int) -> None:
        if bad and not self.skip:
            self.end_line()
            self.lines.append(None)
        self.opened += 1
        self.stack.append((name, bad, self.opened))
        self.skip += bad != 0
        self.tags += bad < 0
        if name in MAIN and not bad:
            self.mains += not self.main
            self.main += 1

    def _pop(self) -> None:
        name, bad, _ = self.stack.pop()
        self.skip -= bad != 0
        self.tags -= bad < 0
        self.main -= name in MAIN and not bad

    def close(self, name: str) -> None:
        if name == "a":
            self.link = max(0, self.link - 1)
        if name in BLOCK:
            self.end_line()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == name:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i][0] in MAIN and name not in ("body", "html"):
                return  # a stray end tag does not end the article


def _parsed(page: str, lifted: set[int] = frozenset()) -> _Lines:
    out, at = _Lines(lifted), 0
    for m in iter(lambda: _TAG.search(page, at), None):
        out.text(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            out.close(name)
            continue
        attrs = m[3] or m[6] or ""
        if name in RAW and not attrs.rstrip().endswith("/"):
            end = re.compile(rf"</{name}\s*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        out.open(name, attrs)
    out.text(page[at:])
    out.end_line()
    return out


def _wrong_hints(found: _Lines) -> set[int]:
    """Numbers of the hints on elements that hold the page's article or most of its text, and of the hints around them."""
    free = [(x.weight, x.main > 0) if x else (0, False) for x in found.lines]
    told = sum(w for w, inside in free if inside)
    every = sum(w for w, _ in free) + sum(n for n, _ in found.held.values())
    surges = told > 0 or any(sum(w for w, _ in free[i : i + WINDOW]) >= SURGE for i in range(len(free)))
    out: set[int] = set()
    for hint, (n, inside) in found.held.items():
        if (inside > told or (n >= SURGE and 2 * n > every)) and not (found.around[hint][1] and surges):
            while hint and hint not in out:
                out.add(hint)
                hint = found.around[hint][0]
    return out


def page_lines(page: str) -> list[Line | None]:
    found = _parsed(page)
    wrong = _wrong_hints(found)
    return _parsed(page, wrong).lines if wrong else found.lines


def main_lines(lines: list[Line | None]) -> list[str]:
    """The lines between surge and dive points, and what belongs to them."""
    weight = [x.weight + BONUS * (x.weight > 0 and x.main > 0) if x else 0 for x in lines]
    main = [x.main if x else -1 for x in lines]
    sums = [sum(weight[k] for k in range(i, min(i + WINDOW, len(lines))) if main[k] == main[i]) for i in range(len(lines))]
    runs: list[tuple[int, int, int, int]] = []  # (text, best window, start, end)
    i = 0
    while i < len(lines):
        if lines[i] is None or not sums[i]:
            i += 1
            continue
        j = i  # a run goes on to boilerplate, to the edge of a main element or to a window without text
        while j < len(lines) and main[j] == main[i] and sums[j]:
            j += 1
        runs.append((sum(weight[i:j]), max(sums[i:j]), i, j))
        i = j
    if not any(weight):  # an article of links alone
        return [x.text for x in lines if x and x.main]
    # the heaviest run is the page's text; where even it has no surge, runs half as dense stay with it
    _, best, _, _ = max(runs, key=lambda r: r[:2])
    level = SURGE if best >= SURGE else best / 2
    core = {k for _, top, i, j in runs if top >= level for k in range(i, j) if weight[k]}
    mains = {main[k] for k in core if main[k]}
    spans: dict[int, tuple[int, int]] = {}  # first and last line that surges, by parent block
    for k in sorted(core):
        for block in () if main[k] else lines[k].own:
            spans[block] = (spans.get(block, (k,))[0], k)

    def belongs(k: int, x: Line) -> bool:
        if x.main:
            return x.main in mains
        around = [spans[b] for b in x.near if b in spans]
        return bool(around) and (x.weight > 0 or x.paragraph or any(a < k < z for a, z in around))

    return [x.text for k, x in enumerate(lines) if x and (k in core or belongs(k, x))]


def main_text(page: str) -> str:
    return "\n\n".join(main_lines(page_lines(page)))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null or empty html gives an empty text; pages cut off in the middle of a tag
    end there; repeated rows give repeated rows; other columns are not read.
    """
    narrow = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(x) for x in b.column("html").to_pylist()]
        cols = [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "text", "n_chars"])

    return arrow_map(narrow, run, f"page_id {narrow.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")


ship_by_value(__name__)
