"""Leaf blocks of HTML pages: text, tag path and the share of linked text, in page order."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

#: Elements that end a block of text, whose content is never text (to the page's end if unclosed; only if closed),
#: that have no content, and that hold no lines.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
RAW = "script|style|textarea|iframe|title"
CLOSED = "template|annotation|annotation-xml"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An element of these is closed by the next of its kind, unless the second list's stands between.
SAME = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
INSIDE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}

HEAD = re.compile(r"<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)", re.I)
#: Elements whose content is left out, with how their end tags look.
ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in (*RAW.split("|"), *CLOSED.split("|"), "svg")}
RAWS = frozenset(RAW.split("|"))
QUOTES = re.compile("[\"'>]")
ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAMED = frozenset(("class", "id", "role", "hidden", "style", "aria-hidden"))
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Element:
    """An element of a tag path, which its ``outer`` element goes on with: paths of one page share their outer parts."""

    __slots__ = ("tag", "names", "outer", "depth", "fresh", "pooled")

    def __init__(self, tag: str, names: str, outer: Element | None, fresh: bool):
        self.tag, self.names, self.outer, self.fresh = tag, names, outer, fresh
        self.depth = outer.depth + 1 if outer else 1
        self.pooled = None  # what a reader of paths makes of the element and all around it


class Token(NamedTuple):
    """Markup from a place to another: a start or end tag, or (without a tag) what is neither tag nor text."""

    start: int
    stop: int
    tag: str = ""
    end: bool = False
    attributes: str = ""


class Scanner:
    """One way through a page. What a search to the page's end has not found is remembered, so that no later tag searches for it again:
    the time is linear in the page's length whatever stands in it."""

    def __init__(self, html: str):
        self.html = html
        self.last = {c: html.rfind(c) for c in ("'", '"', ">")}
        self.unclosed: set[int] = set()
        self.without_end: set[str] = set()

    def tag_stop(self, at: int) -> int:
        """Behind the first > from a place that is in no quotes; -1 if there is none."""
        html, passed = self.html, []
        while at <= self.last[">"]:
            m = QUOTES.search(html, at)
            if m[0] == ">":
                return m.end()
            if m.start() in self.unclosed or m.start() >= self.last[m[0]]:
                break
            passed.append(m.start())
            at = html.find(m[0], m.end()) + 1
        self.unclosed.update(passed)
        return -1

    def behind(self, tag: str, at: int) -> int:
        """Behind the element's end tag; -1 if there is none from here on."""
        if tag in self.without_end:
            return -1
        if m := ENDS[tag].search(self.html, at):
            return m.end()
        self.without_end.add(tag)
        return -1

    def token(self, at: int) -> Token | None:
        """The markup that begins at a place, if it does."""
        html = self.html
        if html.startswith("<!--", at):
            stop = html.find("-->", at + 4)
            return Token(at, stop + 3 if stop >= 0 else len(html))
        if at > self.last[">"]:
            return None
        m = HEAD.match(html, at)
        if not m:
            return Token(at, html.index(">", at + 2) + 1) if html[at + 1 : at + 2] in ("!", "?", "/") and self.last[">"] >= at + 2 else None
        tag, end, name = m["tag"].lower(), bool(m["end"]), m.end()
        if name > self.last[">"]:
            return None
        stop = self.tag_stop(name)
        if stop >= 0 and not end and tag in ENDS and not (tag == "svg" and html[stop - 2] == "/"):
            close = self.behind(tag, stop)
            if close >= 0 or tag in RAWS:
                return Token(at, close if close >= 0 else len(html))
        if stop >= 0:
            return Token(at, stop, tag, end, html[name : stop - 1])
        return Token(at, html.index(">", name) + 1, tag, end)

    def tokens(self) -> Iterator[Token]:
        at = self.html.find("<")
        while at >= 0:
            found = self.token(at)
            if found:
                yield found
            at = self.html.find("<", found.stop if found else at + 1)


class Block(NamedTuple):
    text: str
    path: Element | None
    linked: float


class _Open:
    """Elements that are open. Where the innermost of a kind stands is always known, so that no tag has to search for it."""

    def __init__(self):
        self.stack: list[tuple[str, Element | None, bool]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.kinds: Counter = Counter()

    def path(self) -> Element | None:
        return self.stack[-1][1] if self.stack else None

    def place(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def push(self, tag: str, names: str) -> None:
        path, told = self.path(), tag in BLOCK or bool(names)
        if told:
            self.kinds[tag, names] += 1
            path = Element(tag, names, path, self.kinds[tag, names] == 1)
        at = len(self.stack)
        self.stack.append((tag, path, told))
        self.places.setdefault(tag, []).append(at)
        if tag in BLOCK:
            self.blocks.append(at)

    def cut(self, at: int) -> None:
        """Close all from a place on."""
        while len(self.stack) > at:
            tag, path, told = self.stack.pop()
            self.places[tag].pop()
            if told:
                self.kinds[tag, path.names] -= 1
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()

    def close(self, tag: str) -> None:
        """An end tag; of an element without lines it closes nothing beyond the innermost block."""
        at = self.place((tag,))
        if at >= 0 and (tag in BLOCK or not self.blocks or at > self.blocks[-1]):
            self.cut(at)

    def before(self, tag: str) -> None:
        """What a start tag closes: the element of its kind before it, and an open paragraph."""
        block = self.stack[self.blocks[-1]][0] if self.blocks else ""
        if tag in BLOCK and block == "p" and (tag == "p" or tag not in SAME):
            self.cut(self.blocks[-1])
        elif tag in SAME and tag != "p":
            at = self.place(SAME[tag])
            if at > self.place(INSIDE[tag]):
                self.cut(at)


def _named(attributes: str) -> str:
    """Class, id and role of an element, and "hidden" if it is not shown."""
    names, hidden = [], False
    for k, a, b, c in ATTRIBUTE.findall(attributes):
        k, v = k.lower(), a or b or c
        if k in ("class", "id", "role"):
            names.append(v)
        elif k in NAMED:
            hidden = hidden or k == "hidden" or k == "style" and bool(HIDDEN.search(v)) or k == "aria-hidden" and v == "true"
    return " ".join([*names, "hidden"] if hidden else names).lower()


def blocks(html: str | None) -> list[Block]:
    """Blocks with text of a page, those that are not shown too: their paths say so."""
    out: list[Block] = []
    of, parts, linked = _Open(), [], 0

    def flush() -> None:
        nonlocal linked
        words = "".join(parts).split()
        parts.clear()
        if words:
            text = " ".join(words)
            out.append(Block(text, of.path(), min(1.0, linked / len(text))))
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text := unescape(text) if "&" in text else text)
            if of.places.get("a"):
                linked += len(text.strip())

    html, at = html or "", 0
    for t in Scanner(html).tokens():
        say(html[at : t.start])
        at, tag = t.stop, t.tag
        if not tag:
            continue
        if tag in BLOCK:
            flush()
        elif tag in ("br", "input", "button", "select", "img"):
            parts.append(" ")
        if t.end:
            of.close(tag)
            continue
        of.before(tag)
        attributes = t.attributes
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            of.push(tag, _named(attributes) if attributes and not attributes.isspace() else "")
    say(html[at:])
    flush()
    return out
