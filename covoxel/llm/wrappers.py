"""Main-text extraction with wrappers inferred from the pages of a host."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

#: Wrappers of all hosts are sent to every task up to this many bytes; beyond, they are joined by host and salt.
SENT_BYTES, SALTS, FAN_IN = 32 << 20, 64, 64

# Fixed vocabulary of HTML: what these elements, roles and class or id words stand for.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "ruby", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
ENDS_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "ul"}
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
WALLS = {"table", "ul", "ol", "dl", "div", "article", "section", "body", "select"}
NOT_MAIN = {"nav", "footer", "aside", "form", "head", "button", "select", "menu", "dialog", "svg", "canvas", "object", "audio", "video", "script", "style", "noscript", "template", "iframe", "textarea", "title"}
NOT_MAIN_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
#: Class and id words of elements beside the article, and those that also tell at the front of a longer name.
BESIDE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "promo", "sponsor", "sponsored", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "header", "masthead", "topbar", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "newsletter", "subscribe", "signup", "login", "comment", "comments", "commentlist", "respond", "replies", "disqus", "share", "sharing", "social", "related", "recommended", "popup", "modal", "overlay", "widget", "pagination", "pager", "disclaimer", "copyright", "toolbar"}
FRONT = {"ad", "ads", "advert", "comment", "comments", "cookie", "footer", "nav", "sidebar"}
#: Those of them that may be a part of an article: inside one they tell nothing.
PARTS = {"banner", "header", "footer", "masthead", "topbar", "nav", "navbar", "navigation", "menu", "sidebar", "notice", "notices", "disclaimer", "copyright", "toolbar", "widget"}
#: Elements that hold others rather than text.
HOLDERS = {"html", "body", "div", "section", "article", "main", "center", "details", "table", "tbody", "thead", "tfoot", "tr", "td", "fieldset"}
LISTS = {"ul", "ol", "dl", "menu"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

#: Elements nested deeper count as parts of the one at this depth. A row of more items than ITEMS, or with more names of one
#: tag than NAMES, becomes one repeated group, or loses those names. A task hands on its wrappers when they reach HELD characters.
DEPTH, ITEMS, NAMES, HELD = 100, 150, 24, 32 << 20

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_STOP, _NAME_END = re.compile("[>\"']"), re.compile(r"[\s/>]")
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_PARTS = re.compile(r"[-_:]+|(?<=[a-z0-9])(?=[A-Z])")


def _label(tag: str, attrs: str) -> str:
    """An element's name: its tag and what tells its part on the page; digits don't tell pages apart."""
    if not attrs.strip():
        return tag
    found = {}
    for m in _ATTR.finditer(attrs):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    out = tag
    for key in ("class", "id", "role", "itemprop"):
        if found.get(key):
            out += "." + key[0] + ":" + re.sub(r"\d+", "0", " ".join(found[key].split())).replace("/", "|")
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.IGNORECASE):
        out += ".h:"
    return out


class Scanner:
    """The tags of a page, one after another: where each begins and ends, whether it closes, its name and its attributes (empty
    name: a comment or declaration). A < that no > follows outside of quotes is text.

    Linear in the page, whatever it holds: after the first tag that doesn't end, places outside of quotes from which none ended are
    remembered, and so is the next > or quote.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = {c: html.rfind(c) for c in ">\"'"}
        self.failed: set[int] = set()
        self.sound = True  # every tag so far has ended
        self.ahead = (0, -1)  # from where to where there is no > or quote
        self.named = (0, -1)  # from where to where no name ends

    def _stop(self, at: int) -> int:
        """The next > or quote from `at` on, -1 if there is none."""
        if self.ahead[0] <= at <= self.ahead[1]:
            return self.ahead[1]
        m = _STOP.search(self.html, at) if at <= max(self.last.values()) else None
        if m:
            self.ahead = at, m.start()
        return m.start() if m else -1

    def _name_end(self, at: int) -> int:
        """Where a name that is behind a < with a > somewhere behind it ends."""
        if not self.named[0] <= at <= self.named[1]:
            self.named = at, _NAME_END.search(self.html, at).start()
        return self.named[1]

    def _tag_end(self, at: int) -> int:
        """Where the > stands that ends a tag whose attributes begin at `at`, -1 if there is none."""
        passed = []
        while 0 < at <= self.last[">"]:
            stop = self._stop(at)
            if stop < 0 or stop in self.failed:
                break
            quote = self.html[stop]
            if quote == ">":
                return stop
            passed.append(stop)
            if stop == self.last[quote]:
                break
            at = self.html.find(quote, stop + 1) + 1
        self.failed.update(passed)
        return -1

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        html = self.html
        while (start := html.find("<", at)) >= 0:
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(html), False, "", ""
            if html.startswith(("<!", "<?"), start):
                end = html.find(">", start)
                return start, end + 1 if end >= 0 else len(html), False, "", ""
            at = start + 1
            if start >= self.last[">"]:
                continue
            if self.sound and (m := _TAG.match(html, start)):
                return start, m.end(), bool(m[1]), m[2].lower(), m[3]
            close = html.startswith("/", start + 1)
            first = start + 1 + close
            if html[first].isascii() and html[first].isalpha():
                self.sound = False
                whole = self._name_end(first)
                for stop in dict.fromkeys((whole, min(whole, self._stop(first)))):  # a quote is a name's own only if that ends the tag
                    if (end := self._tag_end(stop)) >= 0:
                        return start, end + 1, close, html[first:stop].lower(), html[stop:end]
        return None


class Page:
    """A page as text blocks and a skeleton of nested elements. Elements open and close as in a browser, roughly: what
    is unclosed ends with its parent."""

    def __init__(self, html: str | None):
        self.blocks: list[tuple[str, int]] = []  # text, characters inside links
        self.owners: list[list] = []  # the skeleton's node of each block
        self.skeleton = ["html", []]
        names, nodes = ["html"], [self.skeleton]
        where, walls = {"html": [0]}, []  # the places of each open name, and of those that WALLS has
        text: list[str] = []
        linked, link = 0, False
        mute: list[str] = []
        html = html or ""
        scanner = Scanner(html)
        at, end = 0, len(html)

        def flush() -> None:
            nonlocal linked, link
            said = " ".join("".join(text).split())
            if said:
                self.blocks.append((said, min(linked, len(said))))
                self.owners.append(nodes[-1])
            text.clear()
            mute.clear()
            linked, link = 0, False

        def shut(k: int) -> None:
            for n in names[k:]:
                where[n].pop()
            while walls and walls[-1] >= k:
                walls.pop()
            del names[k:], nodes[k:]

        while at < end:
            m = scanner.next(at)
            piece = html[at : m[0] if m else end]
            if piece and not mute:
                piece = unescape(piece)
                text.append(piece)
                linked += len(piece) if link else 0
            if m is None:
                break
            _, at, close, tag, attrs = m
            if not tag or tag == "html":
                continue
            if tag in INLINE:  # these don't part blocks; hidden ones are left out
                if close:
                    link = link and tag != "a"
                    if mute and mute[-1] == tag:
                        mute.pop()
                elif tag == "br":
                    text.append(" ")
                elif tag not in VOID:
                    link = link or tag == "a"
                    if mute and tag == mute[-1] or attrs.strip() and _label(tag, attrs).endswith(".h:"):
                        mute.append(tag)
                continue
            if close:
                if where.get(tag):
                    k = where[tag][-1]
                    if tag not in WALLS and walls and walls[-1] > k:
                        continue
                    flush()
                    shut(k)
                elif tag == "p":
                    flush()
                continue
            label = _label(tag, attrs)
            if tag in RAW:
                stop = _ends_raw(tag).search(html, at)
                at = stop.end() if stop else end
                continue
            flush()
            if tag in ENDS_P and where.get("p"):
                shut(where["p"][-1])
            if tag in ENDS_SAME:
                for k in range(len(names) - 1, 0, -1):
                    if names[k] in ENDS_SAME[tag]:
                        shut(k)
                    elif names[k] in WALLS:
                        break
            if tag in ("body", "head"):
                shut(1)
            if tag in VOID:
                continue
            node = nodes[-1]
            if len(nodes) < DEPTH:
                node = [label, []]
                nodes[-1][1].append(node)
            where.setdefault(tag, []).append(len(names))
            if tag in WALLS:
                walls.append(len(names))
            names.append(tag)
            nodes.append(node)
        flush()


@cache
def _ends_raw(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE)


# A wrapper's grammar is a list of items [label, children, optional, repeated]; a label of "()" is a group, one that
# ends in ".*" stands for any element of its tag that tells nothing by its names (see _kind).


def items_of(skeleton: list) -> list:
    """The grammar of one page: children that repeat, alone or in a row of up to six, become repeated items."""
    return bounded(collapse([[label, items_of([label, kids]), False, False] for label, kids in skeleton[1]]))


def _tag(label: str) -> str:
    return label.partition(".")[0]


@cache
def _kind(label: str) -> str:
    """What stands for a label in a row with too many names: what the choice of the article goes by stays, the rest is any element of
    its tag."""
    tag = _tag(label)
    if tag == label or tag == "()":
        return label
    if label.endswith(".h:"):
        return f"{tag}.h:"
    role = next((p for p in label.split(".") if p[:2] == "r:" and (p[2:] in NOT_MAIN_ROLES or p[2:] in ("article", "main"))), None)
    if role or ".i:articlebody" in label.lower():
        return f"{tag}.{role or 'r:article'}"
    for inside in (True, False):
        if _beside_by_name(label, inside):
            return f"{tag}.c:{'ads' if inside else 'header'}-"
    return f"{tag}.*"


def _stands_for_more(label: str) -> bool:
    return label.endswith((".*", ".c:ads-", ".c:header-")) and label == _kind(label) or label.endswith(".*")


def _same(a: list, b: list) -> bool:
    if a[0] == b[0]:
        return a[0] != "()" or [x[0] for x in a[1]] == [x[0] for x in b[1]]
    if _tag(a[0]) != _tag(b[0]) or a[0] == "()":
        return False
    return _stands_for_more(a[0]) and _kind(b[0]) == a[0] or _stands_for_more(b[0]) and _kind(a[0]) == b[0]


def collapse(items: list) -> list:
    for width in range(1, 7):
        out: list = []
        i = 0
        while i < len(items):
            run, times = items[i : i + width], 1
            while len(run) == width and i + (times + 1) * width <= len(items) and all(_same(x, y) for x, y in zip(run, items[i + times * width : i + (times + 1) * width], strict=True)):
                run = [merge_item(x, y) for x, y in zip(run, items[i + times * width : i + (times + 1) * width], strict=True)]
                times += 1
            if times == 1:
                out.append(items[i])
                i += 1
            else:
                out.append([*run[0][:3], True] if width == 1 else ["()", run, False, True])
                i += times * width
        items = out
    return items


def bounded(items: list) -> list:
    """A row of items whose length follows the host's layout and not its number of pages: too many names of a tag are given
    up for their kinds, and too long a row for a repeated group of its items, each once and optional."""
    names: dict[str, set[str]] = {}
    for x in items:
        names.setdefault(_tag(x[0]), set()).add(x[0])
    many = {t for t, n in names.items() if len(n) > NAMES and t != "()"}
    if many:
        items = collapse([[_kind(x[0]), *x[1:]] if _tag(x[0]) in many else x for x in items])
    if len(items) <= ITEMS:
        return items
    kinds: dict[str, list] = {}
    for x in items:
        for y in x[1] if x[0] == "()" else [x]:
            kinds[y[0]] = merge_item(kinds[y[0]], y) if y[0] in kinds and y[0] != "()" else y
    return [["()", [[*x[:2], True, x[3]] for x in kinds.values()], True, True]]


def merge_item(a: list, b: list) -> list:
    return [a[0] if _stands_for_more(a[0]) else b[0], merge(a[1], b[1]), a[2] or b[2], a[3] or b[3]]


def merge(a: list, b: list) -> list:
    """Align two lists of items: what matches is merged, a mismatch becomes an optional item, and neighbours
    that are then alike become one repeated item."""
    if not a or not b:
        return [[*x[:2], True, x[3]] for x in a or b]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(b) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if _same(a[i], b[j]) else max(below[j], row[j + 1])
    out: list = []
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and _same(a[i], b[j]):
            out.append(merge_item(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append([*a[i][:2], True, a[i][3]])
            i += 1
        else:
            out.append([*b[j][:2], True, b[j][3]])
            j += 1
    return bounded(collapse(out))


def expression(items: list) -> str:
    """The grammar as a union-free regular expression over elements."""
    out = []
    for label, kids, optional, repeated in items:
        inside = expression(kids)
        body = f"({inside})" if label == "()" else f"<{label}>{inside}</>" if inside else f"<{label}/>"
        mark = "*" if optional and repeated else "?" if optional else "+" if repeated else ""
        out.append(f"({body}){mark}" if mark and label != "()" else body + mark)
    return "".join(out)


class Automaton:
    """The elements of one list of items in order, and which may follow which: what reads a row of elements."""

    def __init__(self, items: list):
        self.places: list[tuple[str, Automaton, bool]] = []  # label, children, repeated
        self.after: list[dict[str, list[int]]] = []
        self.named: dict[str, int] = {}
        first, last, _ = self._build(items, False)
        self.first: dict[str, list[int]] = {}
        for q in first:
            self.first.setdefault(self.places[q][0], []).append(q)
        self.last = set(last)

    def _build(self, items: list, inside: bool) -> tuple[list[int], list[int], bool]:
        first, last, empty = [], [], True
        for label, kids, optional, repeated in items:
            if label == "()":
                f, l, e = self._build(kids, inside or repeated)
            else:
                f, l, e = [len(self.places)], [len(self.places)], False
                self.named.setdefault(label, len(self.places))
                self.places.append((label, Automaton(kids), inside or repeated))
                self.after.append({})
            for x in [*last, *(l if repeated else [])]:
                for q in f:
                    known = self.after[x].setdefault(self.places[q][0], [])
                    if q not in known:
                        known.append(q)
            e = e or optional
            first = first + f if empty else first
            last = l + last if e else l
            empty = empty and e
        return first, last, empty

    def read(self, labels: list[str]) -> list[int]:
        """The item that each element is an instance of. Where the expression has no such element next, reading
        goes on from the first item of that name, -1 if there is none."""
        out = [-1] * len(labels)
        steps: list[tuple[int, dict[int, int]]] = []

        def settle() -> None:
            if steps:
                q = next((q for q in steps[-1][1] if q in self.last), next(iter(steps[-1][1])))
                for i, back in reversed(steps):
                    out[i] = q
                    q = back[q]
                steps.clear()

        front: dict[int, int] | None = None
        for i, label in enumerate(labels):
            fresh: dict[int, int] = {}
            for name in dict.fromkeys((label, _kind(label), f"{_tag(label)}.*")):
                if front is None:
                    fresh |= {q: -1 for q in self.first.get(name, ())}
                else:
                    for x in front:
                        for q in self.after[x].get(name, ()):
                            fresh.setdefault(q, x)
            if not fresh:
                q = next((self.named[n] for n in (label, _kind(label), f"{_tag(label)}.*") if n in self.named), -1)
                if q < 0:
                    continue
                settle()
                fresh = {q: -1}
            front = fresh
            steps.append((i, fresh))
        settle()
        return out

    def slots(self, page: Page) -> list[str | None]:
        """The text slot of each block: the places of the items on the way to it; null if the expression has none."""
        where: dict[int, str] = {}

        def walk(node: list, items: Automaton, at: str) -> None:
            where[id(node)] = at
            for kid, q in zip(node[1], items.read([k[0] for k in node[1]]), strict=True):
                if q >= 0:
                    walk(kid, items.places[q][1], f"{at}.{q}")

        walk(page.skeleton, self, "")
        return [where.get(id(node)) for node in page.owners]


class Element:
    """An item of a wrapper's grammar with what stands in it and below it on the host's pages."""

    def __init__(self, label: str, items: Automaton, at: str, slots: dict[str, list], repeated: bool):
        self.label, self.tag, self.at, self.repeated = label, _tag(label), at, repeated
        self.kids = [Element(l, a, f"{at}.{q}", slots, r) for q, (l, a, r) in enumerate(items.places)]
        own = slots.get(at)
        self.own = own[1] - own[2] if own else 0
        self.prose = self.own + sum(k.prose for k in self.kids)
        self.slot = [at] if own else []

    def every(self) -> Iterator[Element]:
        yield self
        for k in self.kids:
            yield from k.every()

    def texts(self) -> list[str]:
        return [at for e in self.every() for at in e.slot]

    def without(self, drop: Callable[[Element], bool]) -> None:
        """Leave out the elements below for which drop() holds."""
        self.kids = [k for k in self.kids if not drop(k)]
        for k in self.kids:
            k.without(drop)
        self.prose = self.own + sum(k.prose for k in self.kids)

    def held(self) -> int:
        """Prose of its own and of elements below that aren't inside another holder."""
        return self.own + sum(k.held() for k in self.kids if k.tag not in HOLDERS)


def _beside_by_name(label: str, inside: bool = False) -> bool:
    """Whether a class or id says that an element stands beside the article, or, inside one, is none of its parts."""
    beside, front = (BESIDE - PARTS, FRONT - PARTS) if inside else (BESIDE, FRONT)
    for part in label.split(".")[1:]:
        if part[:2] in ("c:", "i:"):
            for name in part[2:].split():
                words = [w.lower() for w in _PARTS.split(name) if w]
                if name.lower() in beside or words and (words[-1] in beside or words[0] in front):
                    return True
    return False


def _beside_by_kind(e: Element, in_article: bool) -> bool:
    if e.tag in NOT_MAIN or e.label.endswith(".h:") or e.tag == "header" and not in_article:
        return True
    return any(p[2:] in NOT_MAIN_ROLES for p in e.label.split(".") if p[:2] == "r:")


def _is_article(e: Element) -> bool:
    return e.tag == "article" or ".i:articlebody" in e.label.lower() or ".r:article" in e.label


def _records(e: Element) -> bool:
    """Whether an element is mostly a row of like elements of two texts or more without a heading: comments, teasers."""
    for x in e.every():
        if x.repeated and x.tag in HOLDERS | {"li"} and 2 * x.prose > e.prose:
            below = list(x.every())
            return sum(len(y.slot) for y in below) >= 2 and not any(y.tag in HEADINGS for y in below)
    return False


class Wrapper:
    """What the pages of a host have in common: the grammar of their elements, and for each text slot (an element
    of the grammar) its pages, characters, characters in links, least and greatest hash of a page's text there, and blocks."""

    def __init__(self, pages: int = 0, grammar: list | None = None, slots: dict | None = None):
        self.pages, self.grammar, self.slots = pages, grammar, slots or {}
        self.seen: set[bytes] = set()
        self.size = 0

    def add(self, page: Page) -> None:
        text = json.dumps(items := items_of(page.skeleton))
        sign = hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=16).digest()
        if sign not in self.seen:
            self.grammar = items if self.grammar is None else merge(self.grammar, items)
            self.size = max(self.size, len(text))
            if len(self.seen) < 10_000:  # a memory of what needs no second alignment
                self.seen.add(sign)
                self.size += len(sign)
        self.pages += 1

    def fill(self, page: Page, items: Automaton) -> None:
        """Add what a page holds in the slots of the finished grammar."""
        here: dict[str, list] = {}
        for slot, (said, linked) in zip(items.slots(page), page.blocks, strict=True):
            if slot is None:
                continue
            s = here.setdefault(slot, [1, 0, 0, 0, 0, 0])
            s[1] += len(said)
            s[2] += linked
            s[3] = s[4] = zlib.crc32(said.encode("utf-8", "replace"), s[3])
            s[5] += 1
        self.merge_slots(here)

    def merge_slots(self, other: dict[str, list]) -> None:
        for at, s in other.items():
            t = self.slots.get(at)
            self.size += len(at) + 40 if t is None else 0
            self.slots[at] = list(s) if t is None else [t[0] + s[0], t[1] + s[1], t[2] + s[2], min(t[3], s[3]), max(t[4], s[4]), t[5] + s[5]]

    def join(self, other: Wrapper) -> Wrapper:
        self.grammar = other.grammar if self.grammar is None else self.grammar if other.grammar is None else merge(self.grammar, other.grammar)
        self.merge_slots(other.slots)
        self.pages += other.pages
        return self

    def dump(self) -> str:
        return json.dumps([self.pages, self.grammar, self.slots])

    @classmethod
    def load(cls, text: str) -> Wrapper:
        return cls(*json.loads(text))

    def main_slots(self) -> set[str]:
        """The slots that hold the article.

        1. Slots with the same text on all pages that have them are the template, not data, and out, if these are five
        pages and half of the host's or more, and other slots vary.
        2. Elements that by tag, role or the hidden attribute stand beside an article are out. Holders and lists whose class or
        id says so are out unless they are or hold an article, or most of the host's text: a name alone loses no article. Inside an article, names
        that its own parts may have (header, footer, notice, ...) tell nothing.
        3. The article is the host's article elements (those that don't repeat, if there are such), else its main element.
        Where there is neither, it is found from the body down: while one holder, not repeated, has more than half of
        the text, and the text around it isn't mostly in plain sight, it is entered. There, slots that are mostly links are out.
        4. Behind the article's own text, rows of like records without headings are reader comments and teasers, and out.
        """
        varied = any(s[3] != s[4] for s in self.slots.values())
        data = {at: s for at, s in self.slots.items() if not (varied and s[0] >= 5 and 2 * s[0] >= self.pages and s[3] == s[4])}
        top = Element("html", Automaton(self.grammar or []), "", data, False)

        def mark(e: Element, inside: bool) -> None:
            e.inside = inside
            for k in e.kids:
                mark(k, inside or _is_article(e) or e.tag == "main")

        mark(top, False)
        top.without(lambda e: _beside_by_kind(e, e.inside))
        article = lambda e: any(_is_article(x) or x.tag == "main" for x in e.every())
        top.without(lambda e: e.tag in HOLDERS | LISTS and e.tag != "body" and _beside_by_name(e.label, e.inside) and not article(e) and 2 * e.prose <= top.prose)
        found = [e for e in top.every() if _is_article(e) and e.texts()]
        found = [e for e in found if not e.repeated] or found or [e for e in top.every() if (e.tag == "main" or ".r:main" in e.label) and e.texts()][:1]
        if not found:
            e = top
            while True:
                inner = [k for k in e.kids if k.tag in HOLDERS and not k.repeated and 2 * k.prose > e.prose]
                if not inner or 2 * e.held() > e.prose:
                    break
                e = inner[0]
            e.without(lambda x: any(2 * data[at][2] > data[at][1] for at in x.slot))
            found = [e]
        for e in found:
            if 2 * e.held() > e.prose:
                last = max((i for i, k in enumerate(e.kids) if k.tag not in HOLDERS and k.held()), default=-1)
                e.kids = [k for i, k in enumerate(e.kids) if i < last or not _records(k)]
        return {at for e in found for at in e.texts()}


def extract(page: Page, slots: set[str], items: Automaton | None = None) -> str:
    """The blocks in the slots of the grammar, in page order. A page without any is taken as the only one of its host."""
    said = [text for slot, (text, _) in zip(items.slots(page), page.blocks, strict=True) if slot in slots] if items and slots else []
    if not said and page.blocks:
        own = Wrapper()
        own.add(page)
        items = Automaton(own.grammar or [])
        own.fill(page, items)
        slots = own.main_slots()
        said = [text for slot, (text, _) in zip(items.slots(page), page.blocks, strict=True) if slot in slots]
    return "\n".join(said)


def _host() -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) for every host of pages (url, html), from all its pages: the grammar first, then, by
    reading every page with it, what stands in its text slots.

    Each task folds the pages it reads into one wrapper per host; these are joined FAN_IN at a time, level by
    level, so a hot host's pages never meet in one task, only wrappers do, whose size follows the host's
    layout and not its number of pages.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts: dict[str, Wrapper] = {}
        part = 0
        for b in _small(batches):
            for host, html, part in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):  # noqa: B007
                hosts.setdefault(host, Wrapper()).add(Page(html))
            if sum(w.size + 1000 for w in hosts.values()) > HELD:
                yield _rows(hosts, part)
                hosts.clear()
        yield _rows(hosts, part)

    rows = pages.select(_host().alias("host"), "html", F.spark_partition_id().cast("long").alias("part"))
    grammars = _join(stored(rows.mapInArrow(fold, "host string, part long, wrapper string"), "wrappers"))
    rows, held = _with_wrappers(rows, grammars)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts: dict[str, Wrapper] = {}
        part = 0
        for b in _small(batches):
            for (_, items), host, html, part in zip(held(b), *(b.column(c).to_pylist() for c in ("host", "html", "part")), strict=True):  # noqa: B007
                hosts.setdefault(host, Wrapper()).fill(Page(html), items)
            if sum(w.size + 1000 for w in hosts.values()) > HELD:
                yield _rows(hosts, part)
                hosts.clear()
        yield _rows(hosts, part)

    filled = _join(stored(rows.mapInArrow(fill, "host string, part long, wrapper string"), "wrappers"))
    return grammars.join(filled.withColumnRenamed("wrapper", "filled"), "host").mapInArrow(_both, "host string, wrapper string")


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return slices(batches, 500)


def _rows(hosts: dict[str, Wrapper], part: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(hosts), pa.string()), pa.array([part] * len(hosts), pa.int64()), pa.array([w.dump() for w in hosts.values()], pa.string())], names=["host", "part", "wrapper"])


def _join(now: DataFrame) -> DataFrame:
    def join(rows: pd.DataFrame) -> pd.DataFrame:
        out = Wrapper()
        for text in rows.sort_values("part")["wrapper"]:
            out.join(Wrapper.load(text))
        return pd.DataFrame({"host": rows["host"][:1], "part": rows["part"][:1] // FAN_IN, "wrapper": [out.dump()]})

    top = now.agg(F.max("part")).first()[0] or 0
    while True:
        now = stored(now.groupBy("host", F.floor(F.col("part") / FAN_IN).alias("g")).applyInPandas(join, "host string, part long, wrapper string"), "wrappers")
        if top < FAN_IN:
            return now.select("host", "wrapper")
        top //= FAN_IN


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for one, two in zip(b.column("wrapper").to_pylist(), b.column("filled").to_pylist(), strict=True):
            w = Wrapper.load(one)
            w.merge_slots(Wrapper.load(two).slots)
            out.append(w.dump())
        yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(out, pa.string())], names=["host", "wrapper"])


def _with_wrappers(rows: DataFrame, wrappers: DataFrame) -> tuple[DataFrame, Callable[[pa.RecordBatch], Iterator[tuple[set[str], Automaton]]]]:
    """rows (host, html, any others) and what gives for a batch of them each row's slots and grammar.
    wrappers: (host, wrapper as dumped)."""
    size = wrappers.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    table = dict(map(tuple, wrappers.collect())) if size <= SENT_BYTES else None
    memo: dict[str, tuple[set[str], Automaton]] = {}

    def load(text: str | None) -> tuple[set[str], Automaton]:
        if text not in memo:
            if len(memo) >= 1000:
                memo.clear()
            w = Wrapper.load(text) if text else Wrapper()
            memo[text] = set(w.slots), Automaton(w.grammar or [])
        return memo[text]

    def held(b: pa.RecordBatch) -> Iterator[tuple[set[str], Automaton]]:
        return map(load, (table.get(h) for h in b.column("host").to_pylist()) if table is not None else b.column("wrapper").to_pylist())

    if table is None:
        salted = wrappers.select(F.col("host").alias("__of"), "wrapper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__s"))
        rows = rows.withColumn("__salt", F.pmod(F.xxhash64("html", "host"), F.lit(SALTS)).cast("int"))
        rows = rows.join(salted, (F.col("host") == F.col("__of")) & (F.col("__salt") == F.col("__s"))).drop("__of", "__s", "__salt")
    return rows, held


def extract_main(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html, any others) without html, with text and n_chars.

    Three passes over whole pages: the grammars of all hosts are inferred, every page is read with its host's to
    tell data from template, then every page's blocks are kept or dropped by slot. Wrappers go to the tasks as a table
    if all of them together are small (SENT_BYTES), else the pages are joined with them by host and salt, which
    splits hot hosts.

    Null or empty html: empty text, 0. Null urls are one host. Repeated rows are repeated. Columns named text
    or n_chars are replaced. No rows give no rows. Malformed pages are read as far as browsers do: unclosed
    elements end with their parents.
    """
    chosen = stored(infer_wrappers(pages).mapInArrow(_choose, "host string, wrapper string"), "wrappers")
    keep = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    kinds = dict(pages.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", text string, n_chars long"
    rows, held = _with_wrappers(pages.select(F.struct(*keep).alias("row"), "html", _host().alias("host")), chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _small(batches):
            said = [extract(Page(html), slots, items) for (slots, items), html in zip(held(b), b.column("html").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.column("row").flatten(), pa.array(said, pa.string()), pa.array([len(t) for t in said], pa.int64())], names=[*keep, "text", "n_chars"])

    return rows.mapInArrow(run, schema)


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers with the chosen slots alone."""
    for b in batches:
        loaded = [Wrapper.load(w) for w in b.column("wrapper").to_pylist()]
        out = [Wrapper(w.pages, w.grammar, {p: w.slots[p] for p in sorted(w.main_slots())}).dump() for w in loaded]
        yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(out, pa.string())], names=["host", "wrapper"])
