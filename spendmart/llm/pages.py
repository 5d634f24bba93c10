"""Main text of web pages by tree scoring.

A page is read once into blocks of text and the elements around them. What is never text is left out
by its element or its exact role: menus, footers, sidebars, dialogs, controls, code. Forms and elements
that are named after adverts, notices, comments and the like go too, but never one that holds the
page's article or most of its text; names that only mention such a word cost points, and the element
goes if it doesn't read like prose. Every block that is left passes points, for its length and commas,
to the nearest elements around it, less the farther away; an element's points are discounted by its
share of link text. The best element, or the article it lies in, is kept, together with siblings that
score well themselves. Time is linear in the page, however deep it is nested.

Defined results: null or empty html gives an empty text; broken markup is read as far as it goes: an
unfinished tag, comment or script ends with the page, a quote without its pair ends with its tag, and
a closing tag without its opening one only ends a block; of equal scores the innermost element counts,
then the earliest; repeated rows get equal results; a page without any block outside the left-out
elements gives an empty text; very long pages are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_module
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# A value's closing quote is followed by a blank or the tag's end; any other belongs to a later value,
# and the one before it has no pair.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|textarea|noscript|template|svg|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:=\s*\"[^\"]*\"(?=[\s/>])|=\s*'[^']*'(?=[\s/>])|[^>])*)(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\">]*)|'([^'>]*)|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# HTML elements by kind.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("head title nav footer aside button select option datalist dialog menu object fieldset".split())
ROLES_LEFT_OUT = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split()
)
#: Elements that a new block-level element ends.
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Ended by the next one of their kind.
ITEMS = frozenset("li td tr dd dt option".split())
LANDMARKS = frozenset("article main".split())

# Words of class names and ids. A name is split into its parts; its last part that isn't mere
# arrangement says what it names.
COMMENTS = frozenset("comment comments reply replies discussion discussions disqus respond".split())
ASIDES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsors sponsored promo promos "
    "promotion promotions banner sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended widget widgets toolbar search form pagination pager skip".split()
)
#: Not text where they name a page's own header; an entry's is part of the entry.
HEADERS = frozenset("header masthead".split())
ARRANGEMENT = frozenset(
    "list lists box boxes area section sections container containers wrapper wrap block blocks bar bars link links "
    "button buttons inner outer slot unit top bottom left right site page main global primary secondary group item "
    "items panel thread row col column".split()
)
#: A name with one of these says what an element has, not what it is.
ABOUT = frozenset("no not non has have with without hide is".split())
NAMED, MENTIONED, PLAIN, OF_COMMENTS = 2, 1, 0, 3

#: Points that the kind of an element gives or takes, and a name that mentions an aside.
BONUS = {"article": 25.0, "main": 20.0, "section": 5.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "ul": -3.0, "ol": -3.0}
MENTION = -25.0
#: What a block's points are divided by on their way up.
SHARES = (1, 2, 6, 9, 12)
#: A block this long reads like prose, if few of its characters are links.
PROSE, FEW_LINKS = 80, 0.33


def _parts(name: str) -> list[str]:
    """The words of one class or id; ``commentlist`` has two."""
    out = []
    for part in (p.lower() for p in _PART.findall(name)):
        if part not in _KNOWN:
            for i in range(2, len(part) - 1):
                if part[:i] in _KNOWN and part[i:] in _KNOWN:
                    out += [part[:i], part[i:]]
                    break
            else:
                out.append(part)
        else:
            out.append(part)
    return out


_KNOWN = COMMENTS | ASIDES | HEADERS | ARRANGEMENT


@lru_cache(1 << 14)
def named(name: str) -> int:
    """What a class or id says: an aside, reader comments, a mention of such, or nothing."""
    parts = _parts(name)
    if any(p in ABOUT for p in parts):
        return PLAIN
    words = [p for p in parts if not p.isdigit()]
    while len(words) > 1 and words[-1] in ARRANGEMENT:
        words.pop()
    head = words[-1] if words else ""
    if head in COMMENTS:
        return OF_COMMENTS
    if head in ASIDES:
        return NAMED
    if head in HEADERS:
        return NAMED if all(p in HEADERS or p in ARRANGEMENT for p in parts) else PLAIN
    return MENTIONED if any(p in COMMENTS or p in ASIDES for p in words) else PLAIN


class Element:
    __slots__ = ("tag", "parent", "depth", "out", "name", "points", "chars", "link_chars", "longest", "kept")

    def __init__(self, tag: str, parent: Element | None, out: bool, name: int):
        self.tag, self.parent, self.out, self.name = tag, parent, out, name
        self.depth = parent.depth + 1 if parent is not None else 0
        self.points = BONUS.get(tag, 0.0) + (MENTION if name == MENTIONED else 0.0)
        self.chars = self.link_chars = self.longest = 0
        self.kept = False

    def link_share(self) -> float:
        return self.link_chars / self.chars if self.chars else 0.0

    def score(self) -> float:
        return self.points * (1 - self.link_share())


Block = tuple[str, Element, int]


class Reader:
    """Reads a page into ``elements``, parents first, and ``blocks``: text, element, link characters."""

    def __init__(self, page: str):
        root = Element("#root", None, False, PLAIN)
        self.here, self.elements, self.blocks = root, [root], []  # type: Element, list[Element], list[Block]
        self.open: dict[str, int] = {}
        self.pieces: list[str] = []
        self.links = self.link_chars = 0
        self.skipped, self.skip_depth = "", 0  # an inline element left out, and how many of its kind are open
        at = 0
        for m in _TOKEN.finditer(page):
            if m.start() > at:
                self._text(page[at : m.start()])
            at = m.end()
            if m["tag"] is not None:
                self._tag(m["tag"].lower(), bool(m["close"]), m["attrs"])
        if at < len(page):
            self._text(page[at:])
        self._end_block()

    def _text(self, raw: str) -> None:
        if not self.skipped and not self.here.out:
            text = html_module.unescape(raw) if "&" in raw else raw
            self.pieces.append(text)
            if self.links:
                self.link_chars += len(text)

    def _end_block(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append((text, self.here, min(self.link_chars, len(text))))
            self.pieces = []
        self.link_chars, self.skipped, self.skip_depth = 0, "", 0

    def _pop(self) -> None:
        self.open[self.here.tag] -= 1
        self.here = self.here.parent  # type: ignore[assignment]

    def _inline(self, tag: str, close: bool, attrs: str) -> None:
        if self.skipped:
            if tag == self.skipped:
                self.skip_depth += -1 if close else 1
                if not self.skip_depth:
                    self.skipped = ""
        elif not close and tag not in VOID and attrs and self._verdict(attrs)[1] >= NAMED:
            self.skipped, self.skip_depth = tag, 1
        if tag == "a":
            self.links = 0 if close else 1

    def _verdict(self, attrs: str) -> tuple[bool, int]:
        """Whether the role leaves the element out, and what its names say."""
        name = PLAIN
        for kind, *values in _NAMED.findall(attrs):
            for value in "".join(values).split():
                if kind.lower() == "role":
                    if value.lower() in ROLES_LEFT_OUT:
                        return True, name
                else:
                    name = max(name, named(value))
        return False, name

    def _tag(self, tag: str, close: bool, attrs: str) -> None:
        if tag in INLINE:
            self._inline(tag, close, attrs)
            return
        self._end_block()
        if tag in VOID:
            return
        if close:
            self.links = 0
            if self.open.get(tag):
                while self.here.tag != tag:
                    self._pop()
                self._pop()
            return
        while self.here.tag in PARAGRAPHS or (self.here.tag == tag and tag in ITEMS):
            self._pop()
        if tag == "main":
            while self.here.out and self.here.parent is not None:  # an unfinished menu or header
                self._pop()
        if attrs.rstrip().endswith("/") and tag in ("div", "p"):
            return
        self._open(tag, attrs)

    def _open(self, tag: str, attrs: str) -> None:
        out, name = self.here.out or tag in LEFT_OUT, PLAIN
        in_entry = self.open.get("article") or self.open.get("main")
        if not out and attrs and tag not in ("html", "body"):
            by_role, name = self._verdict(attrs)
            out = by_role and tag not in LANDMARKS
            if tag == "main" or (tag == "article" and name != OF_COMMENTS):
                name = PLAIN
        if tag == "form" or (tag == "header" and not in_entry):
            name = max(name, NAMED)
        elif in_entry and name == NAMED and any(p in HEADERS for p in _parts(attrs)):
            name = MENTIONED if tag != "header" else PLAIN
        self.here = Element(tag, self.here, out, name)
        self.open[tag] = self.open.get(tag, 0) + 1
        self.elements.append(self.here)


def _measure(elements: list[Element], blocks: list[Block]) -> None:
    """Characters, link characters and the longest block of each element."""
    for e in elements:
        e.chars = e.link_chars = e.longest = 0
    for text, e, links in blocks:
        e.chars += len(text)
        e.link_chars += links
        # a heading needn't be long
        e.longest = max(e.longest, len(text) if e.tag not in HEADINGS else PROSE)
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.chars += e.chars
            e.parent.link_chars += e.link_chars
            e.parent.longest = max(e.parent.longest, e.longest)


def _leave_out(elements: list[Element]) -> None:
    """Mark what names and forms leave out, and all that lies in it."""
    total = elements[0].chars
    aside = {elements[0]: False}  # in or at an element that a name leaves out
    outside = total
    for e in elements[1:]:
        aside[e] = aside[e.parent] or e.name >= NAMED  # type: ignore[index]
        if aside[e] and not aside[e.parent]:  # type: ignore[index]
            outside -= e.chars
    landmarks = [e for e in elements if e.tag in LANDMARKS and e.chars]
    landmark = max([e for e in landmarks if not aside[e]] or landmarks, key=lambda e: e.chars, default=None)
    safe: set[Element] = set()
    at = landmark
    while at is not None:
        safe.add(at)
        at = at.parent
    alone = 10 * outside < total  # hardly a word lies outside named elements
    for e in elements[1:]:
        if e.parent.out:  # type: ignore[union-attr]
            e.out = True
        elif e.name and not e.out and e not in safe:
            most = 2 * e.chars > total
            if e.name == MENTIONED:
                e.out = not most and (e.longest < PROSE or e.link_share() > FEW_LINKS)
            elif e.name == OF_COMMENTS:
                e.out = not (most and alone)
            else:
                e.out = not (most and (alone or landmark is None))


def main_text(page: str | None) -> str:
    """The blocks of the best element and its kept siblings, joined by one space."""
    read = Reader(page or "")
    elements = read.elements
    _measure(elements, read.blocks)
    _leave_out(elements)
    blocks = [b for b in read.blocks if not b[1].out]
    if not blocks:
        return ""
    _measure(elements, blocks)
    for text, e, _ in blocks:
        points = 1.0 + text.count(",") + min(len(text) // 100, 3)
        at: Element | None = e.parent if e.tag in PARAGRAPHS else e
        for share in SHARES:
            if at is None:
                break
            at.points += points / share
            at = at.parent
    holding = [e for e in elements if e.chars and e.tag not in PARAGRAPHS]
    best = max(holding, key=lambda e: (e.score(), e.depth))
    kept = best
    for tag in ("article", "main"):
        at = best
        while at is not None and at.tag != tag:
            at = at.parent
        if at is not None:
            kept = at
            break
    least = max(10.0, 0.2 * best.score())
    for e in elements:
        if e is kept or (e.parent is not None and e.parent.kept):
            e.kept = True
        elif e.parent is kept.parent and e.parent is not None and e.chars:
            if kept.tag in LANDMARKS:
                e.kept = e.tag in ("article", "section") and e.score() >= least
            elif e.tag in PARAGRAPHS:
                e.kept = e.longest >= PROSE and e.link_share() <= FEW_LINKS
            else:
                e.kept = e.score() >= least
    return " ".join(text for text, e, _ in blocks if e.kept)


def main_text_column(page: Column) -> Column:
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p) for p in pages.to_pylist()], pa.string())

    return F.arrow_udf(extract, "string")(page.cast("string"))
