"""Reads forum rows out of one page: the per-page helper of the page jobs.

A small event handler on the standard library's tokenizer. It follows how a
lenient tree builder nests elements: void elements never nest, an end tag
closes everything up to its latest open start tag, a stray end tag is ignored.

Pages whose markup is regular throughout, which is most of them, are cut into
tags by one regex instead; any page that leaves a doubt takes the slow way.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr "
                 "keygen menuitem basefont bgsound command frame image isindex nextid "
                 "spacer".split())
HIDDEN = frozenset(["script", "style", "template"])
# Elements whose content is not markup.
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript "
                "plaintext".split())
READ = frozenset("tr td img div a span".split())    # tags whose attributes matter

_S = r"[ \t\n\r\f]"
_VALUE = r"\"[^\"<>]*\"|'[^'<>]*'|[^ \t\n\r\f\"'=<>`]+"
ATTRIBUTE = re.compile(rf"([a-zA-Z][-\w]*)(?:{_S}*={_S}*({_VALUE}))?", re.A)
TAG = re.compile(
    rf"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:{_S}+[a-zA-Z][-\w]*(?:{_S}*={_S}*(?:{_VALUE}))?)*+)"
    rf"{_S}*(/?)>", re.A)
DOCTYPE = re.compile(r"\s*<!doctype html>", re.I | re.A)


class _Row:
    """First match of each wanted element inside one table row."""

    def __init__(self, attrs: dict, depth: int):
        self.id = attrs.get("id")
        self.depth = depth
        self.indent_cell = None     # depth of the first indent cell, then "done"
        self.image_width = False    # False until an image is seen in that cell
        self.href = False           # False until a permalink is seen
        self.texts: dict[str, list[str]] = {}

    def top_level(self) -> bool:
        return self.image_width is False or self.image_width == "0"

    def text(self, name: str, sep: str = "") -> str | None:
        return sep.join(self.texts[name]) if name in self.texts else None


class ForumPage(HTMLParser):
    """Collects `tr.athing` rows; `rows` is in document order after `read`."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[_Row] = []
        self._stack: list[tuple[str, list[str]]] = []
        self._open: list[_Row] = []
        self._captures: list[tuple[int, list[str]]] = []
        self._data: list[str] = []

    @classmethod
    def read(cls, html: str) -> list[_Row]:
        page = cls()
        if not page._read_regular(html):
            page.feed(html)
            page.close()
        page._end_text()
        return page.rows

    def _read_regular(self, html: str) -> bool:
        """Run the handlers off one split; False, with nothing done, if in doubt."""
        start = DOCTYPE.match(html)
        pieces = TAG.split(html[start.end():] if start else html)
        # text, then (slash, name, attributes, slash, text) per tag
        if any("<" in text for text in pieces[::5]):
            return False
        names = [name.lower() for name in pieces[2::5]]
        closing = pieces[1::5]
        for i, name in enumerate(names):
            if name in RAW and not closing[i] and not (
                    i + 1 < len(names) and names[i + 1] == name and closing[i + 1]):
                return False
            if closing[i] and pieces[5 * i + 3]:
                return False
        for i, name in enumerate(names):
            at = 5 * i
            if pieces[at] and self._captures:
                self.handle_data(unescape(pieces[at]))
            if closing[i]:
                self.handle_endtag(name)
                continue
            attrs = [(k.lower(), unescape(v[1:-1] if v[:1] in "\"'" else v) if v else None)
                     for k, v in ATTRIBUTE.findall(pieces[at + 3])] if name in READ else []
            self.handle_starttag(name, attrs)
            if pieces[at + 4]:
                self.handle_endtag(name)
        if pieces[-1] and self._captures:
            self.handle_data(unescape(pieces[-1]))
        return True

    def updatepos(self, i, j):
        return j    # line numbers are not needed, and counting them is slow

    def handle_data(self, data):
        if self._captures and not (self._stack and self._stack[-1][0] in HIDDEN):
            self._data.append(data)

    def handle_comment(self, data):
        self._end_text()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_starttag(self, tag, attrs):
        self._end_text()
        attrs = {k: v or "" for k, v in attrs}
        classes = attrs.get("class", "").split()
        depth = len(self._stack)
        for row in self._open:
            self._look(row, tag, classes, attrs, depth)
        if tag == "tr" and "athing" in classes:
            row = _Row(attrs, depth)
            row.is_comment = "comtr" in classes
            self.rows.append(row)
            self._open.append(row)
        if tag not in VOID:
            self._stack.append((tag, classes))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_text()
        for depth in range(len(self._stack) - 1, -1, -1):
            if self._stack[depth][0] == tag:
                del self._stack[depth:]
                self._captures = [c for c in self._captures if c[0] < depth]
                self._open = [r for r in self._open if r.depth < depth]
                for row in self._open:
                    if isinstance(row.indent_cell, int) and row.indent_cell >= depth:
                        row.indent_cell = "done"
                return

    def _look(self, row, tag, classes, attrs, depth):
        if tag == "td" and "ind" in classes and row.indent_cell is None:
            row.indent_cell = depth
        elif tag == "img" and isinstance(row.indent_cell, int) and row.image_width is False:
            row.image_width = attrs.get("width")
        elif tag == "div" and "commtext" in classes:
            self._capture(row, "body", depth)
        elif tag == "a":
            if "hnuser" in classes:
                self._capture(row, "user", depth)
            if row.href is False and any(t == "span" and "age" in c for t, c in self._stack):
                row.href = attrs.get("href")
            if self._stack and self._stack[-1][0] == "span" and "titleline" in self._stack[-1][1]:
                self._capture(row, "title", depth)
            if "titlelink" in classes:
                self._capture(row, "old_title", depth)

    def _capture(self, row, name, depth):
        if name not in row.texts:
            row.texts[name] = []
            self._captures.append((depth, row.texts[name]))

    def _end_text(self):
        """Close the text node; one made of blanks only shrinks to one blank."""
        if self._data:
            node = "".join(self._data)
            if not node.strip(" \t\n\f\r"):
                node = "\n" if "\n" in node else " "
            for _, chunks in self._captures:
                chunks.append(node)
            self._data = []


def comment_rows(html: str, base_url: str, unknown_user: str) -> list[tuple]:
    """(id, text, user, url) of every top-level comment."""
    out = []
    for row in ForumPage.read(html):
        if row.is_comment and row.id is not None and row.top_level():
            user = row.text("user")
            out.append((row.id, (row.text("body", "\n") or "").strip(),
                        unknown_user if user is None else user,
                        "" if row.href is False else f"{base_url}/{row.href}"))
    return out


def index_rows(html: str) -> list[tuple]:
    """(id, title) of every listed thread that has a title link."""
    out = []
    for row in ForumPage.read(html):
        title = row.text("title")
        title = row.text("old_title") if title is None else title
        if row.id is not None and title is not None:
            out.append((row.id, title))
    return out
