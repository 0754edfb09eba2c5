"""Reading a page's elements: the one per-row Python helper, run inside Arrow batches.

A page is read in one go, without building a tree: elements that fit one of the asked
selectors collect the text that follows until they end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

# Fixed values of the HTML standard.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
UNSEEN = frozenset(("script", "style", "template"))

_PART = re.compile(r"([#.]?)([\w-]+)|\[([\w-]+)(?:=([^\]]*))?\]")


def wanted(*selectors: str) -> dict[str, list[tuple[str, list]]]:
    """``tag.class#id[attr=value]`` steps, a space for "somewhere below", by their last tag."""
    by_tag: dict[str, list[tuple[str, list]]] = {}
    for text in dict.fromkeys(selectors):
        steps = [_PART.findall(step) for step in text.split()]
        kind, name = steps[-1][0][:2]
        by_tag.setdefault("" if kind else name, []).append((text, steps))
    return by_tag


def _fits(step: list[tuple], tag: str, attrs: dict) -> bool:
    for kind, name, attr, value in step:
        if attr:
            ok = attr in attrs and (not value or attrs[attr] == value)
        elif kind == "#":
            ok = attrs.get("id") == name
        elif kind == ".":
            ok = name in attrs.get("class", "").split()
        else:
            ok = tag == name
        if not ok:
            return False
    return True


class Found:
    """One element that fits a selector; ``outer`` is the nearest such element around it."""

    def __init__(self, attrs: dict, parent: dict, outer: Found | None):
        self.attrs, self.parent, self.outer = attrs, parent, outer
        self.pieces: list[str] = []

    def around(self) -> Iterator[Found]:
        outer = self.outer
        while outer is not None:
            yield outer
            outer = outer.outer

    def text(self, rendered: bool) -> str:
        if not rendered:
            return "".join(piece.strip() for piece in self.pieces)
        lines = "".join(self.pieces).split("\0")
        return "\n".join(" ".join(line.split()) for line in lines).strip()


class Page(HTMLParser):
    """``found[selector]`` lists the fitting elements in page order.

    ``rendered`` follows a browser: a new block ends an open paragraph and ``<br>`` breaks
    the line. Otherwise an element lasts until its own end tag or that of an outer one.
    """

    def __init__(self, html: str, by_tag: dict, rendered: bool = False):
        super().__init__(convert_charrefs=True)
        self.rendered = rendered
        self.by_tag, self.any_tag = by_tag, by_tag.get("", [])
        self.found: dict[str, list[Found]] = {t: [] for group in by_tag.values() for t, _ in group}
        self.open: list[tuple[str, dict, int]] = []  # tag, attributes, listeners
        self.depth: dict[str, int] = {}
        self.listening: list[Found] = []
        self.text: list[str] = []
        self.feed(html)
        self.close()
        self.flush()

    def flush(self) -> None:
        if self.text:
            piece = "".join(self.text).replace("\0", "")
            self.text = []
            if not (self.open and self.open[-1][0] in UNSEEN):
                self.tell(piece)

    def tell(self, piece: str) -> None:
        for element in self.listening:
            element.pieces.append(piece)

    def handle_data(self, data: str) -> None:
        self.text.append(data)

    def handle_comment(self, data: str) -> None:
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.flush()
        if self.rendered and tag in ENDS_PARAGRAPH:
            self.end("p")
        if self.rendered and tag == "br":
            self.tell("\0")
        given = {name: value or "" for name, value in attrs}
        parent = self.open[-1][1] if self.open else {}
        outer = self.listening[-1] if self.listening else None
        fitting = 0
        for text, steps in [*self.by_tag.get(tag, ()), *self.any_tag]:
            if _fits(steps[-1], tag, given) and self.below(steps[:-1]):
                outer = Found(given, parent, outer)
                self.found[text].append(outer)
                if tag not in VOID:
                    self.listening.append(outer)
                    fitting += 1
        if tag not in VOID:
            self.open.append((tag, given, fitting))
            self.depth[tag] = self.depth.get(tag, 0) + 1

    def below(self, steps: list) -> bool:
        left = list(steps)
        around = reversed(self.open)
        while left:
            tag, attrs, _ = next(around, (None, None, None))
            if tag is None:
                return False
            if _fits(left[-1], tag, attrs):
                left.pop()
        return True

    def handle_endtag(self, tag: str) -> None:
        self.flush()
        self.end(tag)

    def end(self, tag: str) -> None:
        while self.depth.get(tag):
            name, _, fitting = self.open.pop()
            self.depth[name] -= 1
            if fitting:  # the last ones to start listening
                del self.listening[-fitting:]
            if name == tag:
                return

    def first(self, *selectors: str) -> Found | None:
        return next((self.found[s][0] for s in selectors if self.found[s]), None)
