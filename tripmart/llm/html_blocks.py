"""Blocks of text of an HTML page, each with the path of tags above it.

A tolerant reader: tags are matched by one pattern, missing end tags are implied
where HTML allows it, stray ones are passed over, an unclosed comment or script
reaches to the end. Text inside elements that are never shown, or that hold
entries of a form, is left out here; everything else becomes a block.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

# fixed values: element names of HTML
RAW = ["script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"]
HIDDEN = {"template", "noscript", "svg", "object", "canvas", "select", "datalist", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}  # each ends any of them
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn",
          "em", "embed", "font", "i", "img", "input", "ins", "kbd", "label", "map", "mark", "meter",
          "output", "picture", "progress", "q", "ruby", "rp", "rt", "s", "samp", "small", "source",
          "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
# an open element of the first kind ends where one of the second starts, unless
# one of the third lies between
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
           "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table"}),
           "th": ({"td", "th"}, {"table"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
           "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "body": ({"head"}, set())}

_ATTRIBUTES = r"""(?:[^>"']|"[^"]*+"|'[^']*+')*+"""
_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    rf"|<({'|'.join(RAW)})\b{_ATTRIBUTES}>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    rf"|<(/?)([a-z][^\s/>]*+)({_ATTRIBUTES})>"
    r"|<(/?)([a-z][^\s/>]*+)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    text: str
    path: list[str]  # tags and their names (class, id, role), from the root
    link_chars: int  # of its characters, inside links
    leaves: int


def _tokens(tag: str, attributes: str) -> list[str]:
    found = [tag]
    for kind, *values in _NAMES.findall(attributes):
        for word in _WORD.findall(_HUMP.sub(" ", "".join(values)).lower()):
            found.append(f"{'.' if kind.lower() == 'class' else '#' if kind.lower() == 'id' else '@'}{word}")
    return found


class _Reader:
    def __init__(self):
        self.open: list[tuple[str, list[str]]] = []
        self.hidden = 0
        self.links = 0
        self.blocks: list[Block] = []
        self.pieces: list[str] = []
        self.path: list[str] | None = None
        self.linked = self.leaves = 0

    def text(self, raw: str) -> None:
        if self.hidden or not raw:
            return
        shown = unescape(raw) if "&" in raw else raw
        if not shown.isspace():
            if self.path is None:
                self.path = [t for _, tokens in self.open for t in tokens]
            self.leaves += 1
            if self.links:
                self.linked += len(shown.strip())
        self.pieces.append(shown)

    def end_block(self) -> None:
        if self.path is not None:
            text = " ".join("".join(self.pieces).split())
            self.blocks.append(Block(text, self.path, min(self.linked, len(text)), self.leaves))
        self.pieces, self.path, self.linked, self.leaves = [], None, 0, 0

    def push(self, tag: str, attributes: str) -> None:
        self.open.append((tag, _tokens(tag, attributes)))
        self.hidden += tag in HIDDEN
        self.links += tag == "a"

    def pop(self, at: int) -> None:
        """Remove one open element."""
        tag = self.open.pop(at)[0]
        self.hidden -= tag in HIDDEN
        self.links -= tag == "a"

    def close(self, tags: set[str], not_beyond: set[str]) -> None:
        """End the outermost open element of ``tags`` and all inside it."""
        found = None
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] in not_beyond:
                break
            if self.open[at][0] in tags:
                found = at
        if found is not None:
            while len(self.open) > found:
                self.pop(-1)

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.pieces.append(" ")
            return
        if tag not in INLINE:
            self.end_block()
            self.close({"p"}, {"table", "td", "th", "button", "blockquote", "div", "article", "li"})
        if tag in IMPLIED:
            self.close(*IMPLIED[tag])
        if tag == "a":
            self.end("a")
        if tag not in VOID:
            self.push(tag, attributes)

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.end_block()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag or {self.open[at][0], tag} <= HEADINGS:
                if tag in INLINE:
                    self.pop(at)
                else:
                    while len(self.open) > at:
                        self.pop(-1)
                return
            if tag in INLINE and self.open[at][0] not in INLINE:
                return  # an inline element does not end outside its block


def blocks(html: str | None) -> list[Block]:
    """All blocks with text, in page order."""
    reader, at = _Reader(), 0
    html = html or ""
    for found in _MARKUP.finditer(html):
        reader.text(html[at:found.start()])
        at = found.end()
        tag = found[3] or found[6]
        if tag is None:
            continue
        tag = tag.lower()
        if found[2] or found[5]:
            reader.end(tag)
        else:
            attributes = found[4] or found[7] or ""
            reader.start(tag, attributes)
            if attributes.endswith("/") and tag in HIDDEN:
                reader.end(tag)  # <svg/>
    reader.text(html[at:])
    reader.end_block()
    return reader.blocks
