"""Reading of raw HTML into a tree of the elements that can hold a page's main text.

Tags are cut as browsers cut them: an attribute value ends at its own quote, an unquoted one at
white space or ``>`` whatever else it holds, a tag that the page breaks off is no text, and what
scripts, styles, titles, frames and other embedded elements hold is no text either. One departure
saves text: a value whose closing quote is missing (none comes, or the next one is followed by
neither white space, ``/`` nor ``>`` and a ``>`` lies before it) ends at the first ``>``.

Block elements are nodes, and so are inline elements whose class, id or role has a word of
``WORDS``; other inline elements belong to the node around them. The time is linear in the page.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

GROUPS = {
    "main": ("article", "main"), "section": ("section",), "div": ("div", "center"),
    "text": ("p", "blockquote", "pre", "figcaption", "address", "details", "summary"),
    "heading": ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"), "list": ("ul", "ol", "dl"),
    "item": ("li", "dd", "dt"), "table": ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"),
    "nav": ("nav", "menu"), "header": ("header",), "footer": ("footer",), "aside": ("aside", "dialog"),
    "form": ("form", "fieldset", "button", "label", "legend", "option"), "page": ("html", "body"),
    "figure": ("figure",), "head": ("head", "title"),
}
GROUP_OF = {tag: k for k, tags in enumerate(GROUPS.values()) for tag in tags}
NAMES = list(GROUPS)
WORDS = {
    "nav": ("nav", "menu", "breadcrumb", "pagin", "pager", "tabs", "toc", "skip"),
    "ad": ("advert", "sponsor", "promo", "banner", "adbox", "adslot", "ads", "ad"),
    "foot": ("foot", "copyright", "legal", "colophon"),
    "head": ("header", "masthead", "topbar", "logo", "branding"),
    "side": ("side", "widget", "related", "recommend", "popular", "trending", "share", "social", "newsletter", "subscri", "rail"),
    "comment": ("comment", "disqus", "repl", "respond", "discussion", "feedback"),
    "notice": ("cookie", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "paywall", "warning"),
    "form": ("form", "search", "login", "signup", "signin", "register"),
    "main": ("article", "content", "post", "entry", "story", "main", "body", "text", "prose"),
}
EXACT = {"ad", "ads"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Elements that a new element of the key ends, up to the elements that keep them open.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
BLOCKS = set(GROUP_OF) - {"label", "option", "title"} | {"hr"}
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "noembed", "noframes"}  # end at their own end tag only
DROPPED = {"svg", "math", "template", "select", "datalist", "object", "video", "audio", "canvas"}  # with all that they hold
SCOPE = {"table", "td", "th", "caption", "button"}  # a paragraph outside these stays open

START = re.compile(r"<(?:(/?)([a-zA-Z][^ \t\n\f\r/>]*)|(!--)|[!?/])")
ATTRIBUTE = re.compile(
    r"[ \t\n\f\r/]*([^ \t\n\f\r/>][^ \t\n\f\r/>=]*)"
    r"(?:[ \t\n\f\r]*=[ \t\n\f\r]*(?:\"([^\">]*)\"|'([^'>]*)'|\"([^\"]*)\"(?=[ \t\n\f\r/>])|'([^']*)'(?=[ \t\n\f\r/>])"
    r"|[\"']([^>]*)|([^ \t\n\f\r>]*)))?")
TAG_END = re.compile(r"[ \t\n\f\r/]*>")
COMMENT_END = re.compile(r"--!?>")
RAW_END = {name: re.compile(rf"</{name}(?=[ \t\n\f\r/>])", re.I) for name in RAW}


def tokens(text: str) -> Iterator[tuple[str, str, dict[str, str] | None]]:
    """("text", characters, None), ("start", name, attributes), ("empty", ...) for ``/>`` and ("end", ...)."""
    at = 0
    while (m := START.search(text, at)) is not None:
        if m.start() > at:
            yield "text", text[at:m.start()], None
        at = m.end()
        if m.group(3):  # a comment; <!--> and <!---> are whole ones
            short = 1 if text.startswith(">", at) else 2 if text.startswith("->", at) else 0
            end = None if short else COMMENT_END.search(text, at)
            at = at + short if short else end.end() if end else len(text)
        elif m.group(2) is None:
            at = text.find(">", at) + 1 or len(text)
        else:
            attributes: dict[str, str] = {}
            while (a := ATTRIBUTE.match(text, at)) is not None:
                at = a.end()
                attributes.setdefault(a.group(1).lower(), next((g for g in a.groups()[1:] if g is not None), ""))
            end = TAG_END.match(text, at)
            if end is None:
                return  # the page ends inside a tag
            at = end.end()
            name = m.group(2).lower()
            yield "end" if m.group(1) else "empty" if text[at - 2] == "/" else "start", name, attributes
            if not m.group(1) and name in RAW:
                end = RAW_END[name].search(text, at)
                at = end.start() if end else len(text)
    if at < len(text):
        yield "text", text[at:], None


def word_flags(marks: str) -> list[int]:
    """Numbers of the word groups that class, id or role words belong to."""
    if not marks:
        return []
    tokens = re.split(r"[^a-z0-9]+", marks)
    return [k for k, prefixes in enumerate(WORDS.values())
            if any(t in EXACT and t in prefixes or any(t.startswith(p) for p in prefixes if p not in EXACT) for t in tokens)]


class Page:
    """Node tree of a page: parents, features' raw material, and text pieces by owner."""

    __slots__ = ("parent", "tag", "marks", "pieces", "linked", "labelled", "_stack", "_open")

    def __init__(self, text: str):
        self.parent, self.tag, self.marks = [-1], ["html"], [""]
        self.pieces: list[tuple[int, str]] = []  # owner and text; a piece of one blank ends a block
        self.linked = [0]
        self.labelled: list[int] = []
        # Open elements: name, node (-1: dropped with all it holds), place of the paragraph that a block ends, or -1.
        self._stack: list[tuple[str, int, int]] = [("html", 0, -1)]
        self._open: defaultdict[str, list[int]] = defaultdict(list)  # places in the stack by name
        for kind, value, attributes in tokens(text):
            if kind == "text":
                self._text(value)
            elif kind == "end":
                self._close(value)
            elif kind == "start" or value not in ("svg", "math"):  # ``/>`` ends these two alone
                self._start(value, attributes)

    def _text(self, raw: str) -> None:
        owner = self._stack[-1][1]
        if owner >= 0:
            value = entities.unescape(raw)
            self.pieces.append((owner, value))
            if self._open["a"]:
                self.linked[owner] += len(value)

    def _break(self) -> None:
        if self._stack[-1][1] >= 0:
            self.pieces.append((self._stack[-1][1], " "))

    def _push(self, name: str, node: int) -> None:
        paragraph = len(self._stack) if name == "p" else -1 if name in SCOPE else self._stack[-1][2]
        self._open[name].append(len(self._stack))
        self._stack.append((name, node, paragraph))

    def _last(self, names: set[str]) -> int:
        return max((self._open[x][-1] for x in names if self._open[x]), default=0)

    def _cut(self, k: int) -> None:
        for name, _, _ in self._stack[k:]:
            self._open[name].pop()
        del self._stack[k:]

    def _node(self, name: str, marks: str, attributes: dict[str, str]) -> int:
        node = len(self.parent)
        self.parent.append(self._stack[-1][1])
        self.tag.append(name)
        self.marks.append(marks)
        self.linked.append(0)
        if "data-main" in attributes:
            self.labelled.append(node)
        return node

    def _start(self, name: str, attributes: dict[str, str]) -> None:
        if name in VOID or name in RAW:
            if name == "hr":
                self._end_paragraph()
            if name in ("br", "hr"):
                self._break()
            return
        if name in DROPPED or self._stack[-1][1] < 0:
            self._push(name, -1)
            return
        marks = " ".join(entities.unescape(v).lower() for k, v in attributes.items() if k in ("class", "id", "role"))
        if name in BLOCKS:
            self._end_paragraph()
            if name in ENDS:
                ended, bound = ENDS[name]
                k = self._last(ended)
                if k > self._last(bound):
                    self._cut(k)
            self._break()
            self._push(name, self._node(name, marks, attributes))
        elif word_flags(marks):
            self._push(name, self._node(name, marks, attributes))
        else:
            self._push(name, self._stack[-1][1])

    def _end_paragraph(self) -> None:
        k = self._stack[-1][2]
        if k > 0:
            self._break()
            self._cut(k)

    def _close(self, name: str) -> None:
        k = self._last({name})
        # An end tag does not end what lies outside the page's large parts.
        if k == 0 or (k < self._last({"article", "body"}) and name not in ("article", "body", "html", "main", "div")):
            return
        if name in BLOCKS and self._stack[k][1] >= 0:
            self.pieces.append((self._stack[k][1], " "))
        self._cut(k)
