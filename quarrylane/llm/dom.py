"""A forgiving HTML reader: elements that hold blocks of text, in page order."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math textarea select head title canvas video audio".split())
#: Their content is no markup, and without an end tag it goes to the end of the page.
PLAIN = frozenset("script style textarea title iframe".split())
#: What can stand in a head; any other element, end tag or text ends one that has no end tag.
HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
#: Elements that end a drawing or formula without an end tag, unless they are in one of those that hold HTML.
NOT_DRAWN = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
HTML_INSIDE = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt".split())
ITEM_OF = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
SAME_ITEM = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

#: A value in quotes (only after an equals sign: elsewhere a quote is a character like any other) or without. Nothing is tried twice.
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]++)"
_ATTRIBUTES = rf"(?:[\s/=]++|[^\s/>=]++(?:\s*+=\s*+{_VALUE}?+)?+)*+"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})>", re.S)
_OPEN = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(rf"([^\s/>=]++)(?:\s*+=\s*+({_VALUE})?+)?+")


class Element:
    """An element that is not inline: its place in the tree and the text right inside it."""

    __slots__ = ("tag", "attributes", "parent", "children", "depth", "chars", "link_chars", "links", "inline", "index", "place")

    def __init__(self, tag: str, attributes: str, parent: Element | None, index: int):
        self.tag, self.attributes, self.parent, self.index = tag, attributes, parent, index
        self.children: list[Element] = []
        self.depth = parent.depth + 1 if parent else 0
        self.chars = self.link_chars = self.links = self.inline = 0
        self.place = len(parent.children) if parent else 0
        if parent:
            parent.children.append(self)

    def attribute(self, name: str) -> str:
        for m in _ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                value = m[2] or ""
                return unescape(value[1:-1] if value[:1] in ('"', "'") else value)
        return ""


def _without_open_end(html: str, at: int) -> str:
    """A page without a tag that its end cuts off; no tag ends from `at` on."""
    start = _OPEN.search(html, at)
    return html[: start.start()] if start else html


class _Ends:
    """Where the next end tag of an element is; the rest of a page is searched once for each name, not for each start tag."""

    def __init__(self, html: str):
        self.html = html
        self.found: dict[str, re.Match | None] = {}

    def after(self, tag: str, at: int) -> re.Match | None:
        known = self.found.get(tag, self)
        if known is self or (known is not None and known.start() < at):
            known = self.found[tag] = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(self.html, at)
        return known

    def plain(self, tag: str, at: int) -> int:
        """Where an element without markup in it ends."""
        end = self.after(tag, at)
        return end.end() if end else len(self.html)


class _Stack:
    """The open elements, and for each name where it stands among them: no question about them walks through them."""

    def __init__(self, root: Element):
        self.items = [("#root", root)]
        self.at: dict[str, list[int]] = {}
        self.blocks = [0]  # not inline
        self.walls = [0]  # neither inline nor p: an inline end tag does not reach beyond

    def push(self, tag: str, element: Element) -> None:
        k = len(self.items)
        self.items.append((tag, element))
        self.at.setdefault(tag, []).append(k)
        if tag not in INLINE:
            self.blocks.append(k)
            if tag != "p":
                self.walls.append(k)

    def pop(self) -> str:
        tag, _ = self.items.pop()
        k = self.at[tag].pop()
        for places in (self.blocks, self.walls):
            if places[-1] == k:
                places.pop()
        return tag

    def last(self, *tags: str) -> int:
        """The place of the innermost open element with one of the names; 0 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def reached(self, tag: str) -> int:
        """The place of the element that an end tag closes; 0 if there is none that it can reach."""
        k = self.last(tag)
        return k if tag not in INLINE or k > self.walls[-1] else 0


def _head_end(html: str, at: int, ends: _Ends) -> int:
    """Where a head without an end tag ends: before the first thing that cannot stand in a head."""
    while m := _TOKEN.search(html, at):
        if html[at : m.start()].strip():
            return at
        tag = (m[2] or "").lower()
        if tag and not (tag in HEAD and (not m[1] or tag in ("noscript", "template"))):
            return m.start()
        at = ends.plain(tag, m.end()) if tag in PLAIN else m.end()
        if tag in ("noscript", "template") and not m[1]:
            end = ends.after(tag, at)
            at = end.end() if end else at
    return at


def _subtree_end(html: str, tag: str, at: int, stack: _Stack, has_end: bool, ends: _Ends) -> int:
    """Where an element that is left out ends: at its end tag, or before what closes an element around it."""
    opened, counts = [tag], Counter([tag])
    inside = lambda names: any(counts[n] for n in names)
    while m := _TOKEN.search(html, at):
        name, at = (m[2] or "").lower(), m.end()
        if not name:
            continue
        if m[1]:
            if counts[name]:
                while (closed := opened.pop()) != name:
                    counts[closed] -= 1
                counts[name] -= 1
                if not opened:
                    return at
            elif stack.reached(name):
                return m.start()
            continue
        if tag in ("svg", "math"):
            if name in NOT_DRAWN and not inside(HTML_INSIDE):
                return m.start()
        elif not has_end and tag in ("noscript", "canvas", "audio", "video"):
            if name in CLOSES_P and stack.last("p") and not counts["p"]:
                return m.start()
            if name in SAME_ITEM and any(stack.reached(n) for n in SAME_ITEM[name]) and not inside(ITEM_OF[name]) and not inside(SAME_ITEM[name]):
                return m.start()
        if name in VOID or m[3].rstrip().endswith("/"):
            continue
        if name in PLAIN:
            at = ends.plain(name, at)
        else:
            opened.append(name)
            counts[name] += 1
    return len(html)


def read(html: str | None) -> tuple[list[Element], list[tuple[Element, str]]]:
    """All elements in page order (the first is the root), and the blocks as (element, text)."""
    html = _without_open_end(html or "", html.rfind(">") + 1 if html else 0)
    root = Element("#root", "", None, 0)
    elements, blocks, buffer = [root], [], []
    stack = _Stack(root)  # inline elements point to the element they are in
    links, at, n, ends = 0, 0, len(html), _Ends(html)

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                blocks.append((stack_top(), text))
            buffer.clear()

    def stack_top() -> Element:
        return stack.items[-1][1]

    def pop_to(k: int) -> None:
        nonlocal links
        while len(stack.items) > k:
            tag, _ = stack.items[-1]
            if tag in INLINE:
                links -= tag == "a"
            else:
                flush()
            stack.pop()

    def add(text: str) -> None:
        if text:
            if "&" in text:
                text = unescape(text)
            buffer.append(text)
            size = len(text.strip())
            if size:
                top = stack_top()
                top.chars += size
                if links:
                    top.link_chars += size

    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            add(_without_open_end(html, at)[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if k := stack.reached(tag):
                if tag not in INLINE:
                    flush()
                pop_to(k)
            continue
        if tag in RAW:
            if m[3].rstrip().endswith("/"):
                continue
            end = ends.after(tag, at)
            if tag == "head":
                at = end.end() if end else _head_end(html, at, ends)
            elif tag in PLAIN or (tag == "noscript" and end):
                at = end.end() if end else n
            else:
                at = _subtree_end(html, tag, at, stack, end is not None, ends)
            buffer.append(" ")
            continue
        if tag in VOID:
            buffer.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag in INLINE:
            top = stack_top()
            top.inline += 1
            if tag == "a":
                links += 1
                top.links += 1
            stack.push(tag, top)
            continue
        if tag in CLOSES_P and stack.items[k := stack.blocks[-1]][0] == "p":
            flush()
            pop_to(k)
        if tag in SAME_ITEM:
            while (k := stack.last(*SAME_ITEM[tag])) > stack.last(*ITEM_OF[tag] - SAME_ITEM[tag]):
                flush()
                pop_to(k)
                if not (tag == "tr" and stack.items[-1][0] == "tr"):
                    break
        if tag in ("html", "body") and stack.last(tag):
            continue
        flush()
        element = Element(tag, m[3], stack_top(), len(elements))
        elements.append(element)
        stack.push(tag, element)
    flush()
    return elements, blocks
