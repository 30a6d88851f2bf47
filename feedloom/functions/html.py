"""HTML to text with line breaks, as an Arrow UDF.

The rule is a function of the parsed tree, so one pass with a stack of open elements is enough:
block elements end with a line break and start with one unless the element before them, within
the same parent, is a block too; list items and ``br`` end with one. Script text is dropped before
that and never counts as a neighbour; style and template text is dropped but the element counts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.entities import name2codepoint
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

from feedloom.functions.text import strip

# How the published tree builder treats tags and characters.
BLOCK_TAGS = frozenset(["p", "div", "h1", "h2", "h3", "h4", "h5", "h6"])
BREAK_TAGS = frozenset(["li", "br"])
HIDDEN_TEXT_TAGS = frozenset(["style", "template"])
KEEP_SPACE_TAGS = frozenset(["pre", "textarea"])
VOID_TAGS = frozenset([
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr",
    "image", "img", "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param",
    "source", "spacer", "track", "wbr",
])
ASCII_SPACE = " \n\t\f\r"


class Frame:
    __slots__ = ("tag", "last_child", "visible")

    def __init__(self, tag):
        self.tag = tag
        self.last_child = None  # name of the last child element that is not a script
        self.visible = True


class PageText(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.out = []
        self.run = []  # pieces of the text node being read
        self.stack = [Frame("")]
        self.scripts = 0  # open script elements
        self.hidden = 0  # open style and template elements
        self.kept_space = 0
        self.closed_voids = []

    def _end_text(self):
        if not self.run:
            return
        text = "".join(self.run)
        self.run = []
        if not self.kept_space and not text.strip(ASCII_SPACE):
            text = "\n" if "\n" in text else " "
        if not self.scripts and not self.hidden:
            self.out.append(text)

    def _line_break(self):
        if not self.scripts:
            self.out.append("\n")

    def _open(self, tag):
        self._end_text()
        parent = self.stack[-1]
        if tag in BLOCK_TAGS and parent.last_child not in BLOCK_TAGS:
            self._line_break()
        if tag == "script":
            self.scripts += 1
        else:
            parent.last_child = tag
        self.hidden += tag in HIDDEN_TEXT_TAGS
        self.kept_space += tag in KEEP_SPACE_TAGS
        self.stack.append(Frame(tag))

    def _close(self, tag):
        self._end_text()
        if not any(frame.tag == tag for frame in self.stack[1:]):
            return
        while True:
            closed = self.stack.pop().tag
            self.scripts -= closed == "script"
            self.hidden -= closed in HIDDEN_TEXT_TAGS
            self.kept_space -= closed in KEEP_SPACE_TAGS
            if closed in BLOCK_TAGS or closed in BREAK_TAGS:
                self._line_break()
            if closed == tag:
                return

    def handle_starttag(self, tag, attrs):
        self._open(tag)
        if tag in VOID_TAGS:
            self._close(tag)
            self.closed_voids.append(tag)

    def handle_startendtag(self, tag, attrs):
        self._open(tag)
        self._close(tag)

    def handle_endtag(self, tag):
        if tag in self.closed_voids:
            self.closed_voids.remove(tag)
        else:
            self._close(tag)

    def handle_data(self, data):
        self.run.append(data)

    def handle_entityref(self, name):
        point = name2codepoint.get(name)
        self.run.append(chr(point) if point else "&" + name)

    def handle_charref(self, name):
        point = -1
        try:
            point = int(name[1:], 16) if name[:1] in "xX" else int(name)
            # Numbers below 256 are often meant as Windows characters.
            text = bytes([point]).decode("windows-1252") if point < 256 else chr(point)
        except (UnicodeDecodeError, OverflowError, ValueError):
            try:
                text = chr(point)
            except (OverflowError, ValueError):
                text = ""
        self.run.append(text or "\N{REPLACEMENT CHARACTER}")

    def handle_comment(self, data):
        self._end_text()

    def handle_decl(self, decl):
        self._end_text()

    def handle_pi(self, data):
        self._end_text()

    def unknown_decl(self, data):
        self._end_text()
        if data.upper().startswith("CDATA[") and not self.scripts:
            self.out.append(data[len("CDATA["):])

    def text(self):
        self.close()
        self._end_text()
        while len(self.stack) > 1:
            self._close(self.stack[-1].tag)
        return "".join(self.out).strip()


def html_text(html: str | None) -> str:
    """Text of one HTML string; the column version is :func:`clean_html`."""
    if html is None:
        return ""
    page = PageText()
    page.feed(html)
    return page.text()


#: Pages held as Python texts at once; a batch can be thousands of them.
PIECE = 64


@F.arrow_udf(T.StringType())
def _clean_html(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for html in batches:
        for start in range(0, len(html), PIECE):
            yield pa.array([None if value is None else html_text(value)
                            for value in html.slice(start, PIECE).to_pylist()], pa.string())


# Executors get the parser with the UDF and need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def clean_html(c: Column) -> Column:
    """Text with line breaks of an HTML column; null gives the empty string.

    Text without ``<`` and ``&`` holds no markup: it is trimmed in the JVM and the UDF only sees
    a null for it.
    """
    marked = F.contains(c, F.lit("<")) | F.contains(c, F.lit("&"))
    return (F.when(c.isNull(), "")
            .when(marked, _clean_html(F.when(marked, c)))
            .otherwise(strip(c)))
