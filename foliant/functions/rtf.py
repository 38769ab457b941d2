"""A bounded subset of markup as 7-bit RTF.

Paragraphs, headings, breaks, bold, italic, underline, strike, super- and subscript, font size and colour
of inline styles, links, and tables: rows and cells with their widths and spans, or, where a table holds another one or no
rows, tabbed lines. Other elements give their content only. No claim of
equality with a layout library is made.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .markup_tree import VOID, Tag, children, parse, style_of

HEAD = "{\\rtf1\\ansi\\ansicpg1252\\deff0{\\fonttbl{\\f0 Calibri;}}"
ON = {"b": "\\b", "strong": "\\b", "i": "\\i", "em": "\\i", "u": "\\ul", "ins": "\\ul", "s": "\\strike", "strike": "\\strike", "del": "\\strike", "sup": "\\super", "sub": "\\sub"}
SIZES = {"h1": 48, "h2": 36, "h3": 28, "h4": 24, "h5": 20, "h6": 18}
BLOCKS = frozenset("p div li tr table ul ol blockquote section article header footer body".split()) | frozenset(SIZES)
HIDDEN = frozenset(("head", "script", "style", "title"))
HREF = re.compile(r"(?:^|\s)href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
RGB = re.compile(r"(?:^|;)\s*color\s*:\s*(?:rgb\(\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*\)|#([0-9a-f]{6})\b)", re.I)
SIZE = re.compile(r"(?:^|;)\s*font-size\s*:\s*(\d+(?:\.\d+)?)\s*(pt|px)", re.I)

SPAN = re.compile(r"(?:^|\s)colspan\s*=\s*[\"']?\s*(\d{1,4})", re.I)
WIDTH = re.compile(r"(?:^|\s)width\s*=\s*[\"']?\s*(\d+(?:\.\d+)?)\s*(%|px)?", re.I)
#: Width of a table, and the gap between its cells, in twentieths of a point.
TABLE_WIDTH, CELL_GAP = 9000, 108


def escape(text: str) -> str:
    out = []
    for c in text:
        code = ord(c)
        if c in "\\{}":
            out.append("\\" + c)
        elif c == "\t":
            out.append("\\tab ")
        elif code < 0x80:
            out.append(c if code >= 32 else " ")
        else:
            units = [code] if code < 0x10000 else [0xD800 + ((code - 0x10000) >> 10), 0xDC00 + ((code - 0x10000) & 0x3FF)]
            out += [f"\\u{u if u < 0x8000 else u - 0x10000}?" for u in units]
    return "".join(out)


class Writer:
    def __init__(self) -> None:
        self.out: list[str] = []
        self.colours: list[tuple[int, int, int]] = []
        self.open: list[tuple[str, str]] = []  # name, what ends it
        self.fresh = True  # nothing in this paragraph yet

    def text(self, raw: str) -> None:
        if any(n in HIDDEN for n, _ in self.open):
            return
        text = re.sub("[ \t\r\n\f]+", " ", unescape(raw))
        if self.fresh:
            text = text.lstrip(" ")
        if text:
            self.out.append(escape(text))
            self.fresh = False

    def paragraph(self) -> None:
        if not self.fresh:
            self.out.append("\\par\n")
            self.fresh = True

    def style(self, attributes: str) -> str:
        style, words = style_of(attributes) or "", ""
        low = style.lower()
        if colour := RGB.search(style):
            rgb = tuple(int(x) & 255 for x in colour.groups()[:3]) if colour[1] else tuple(int(colour[4][k : k + 2], 16) for k in (0, 2, 4))
            if rgb not in self.colours:
                self.colours.append(rgb)
            words += f"\\cf{self.colours.index(rgb) + 1}"
        if size := SIZE.search(style):
            words += f"\\fs{round(float(size[1]) * (2 if size[2].lower() == 'pt' else 1.5))}"
        lines = re.search(r"text-decoration(?:-line)?\s*:([^;]*)", low)
        for word, control in (("line-through", "\\strike"), ("underline", "\\ul")):
            if lines and word in lines[1]:
                words += control
        if re.search(r"font-weight\s*:\s*(bold|[6-9]00)", low):
            words += "\\b"
        if re.search(r"font-style\s*:\s*italic", low):
            words += "\\i"
        return words

    def start(self, name: str, attributes: str, leaf: bool) -> None:
        if name == "br":
            self.out.append("\\line\n")
            return
        if name in BLOCKS:
            self.paragraph()
        if name in ("td", "th") and not self.fresh:
            self.out.append("\\tab ")
        if leaf:
            return
        words = ON.get(name, "") + (f"\\b\\fs{SIZES[name]}" if name in SIZES else "") + self.style(attributes)
        href = HREF.search(attributes) if name == "a" else None
        end = ""
        if href:
            target = escape(next(g for g in href.groups() if g is not None).replace('"', "%22"))
            self.out.append(f'{{\\field{{\\*\\fldinst HYPERLINK "{target}"}}{{\\fldrslt ')
            end = "}}"
        if words:
            self.out.append("{" + words + " ")
            end = "}" + end
        if name == "li":
            self.out.append("\\u8226?\\~")
            self.fresh = False
        self.open.append((name, end))

    def end(self, name: str) -> None:
        at = next((k for k in range(len(self.open) - 1, -1, -1) if self.open[k][0] == name), None)
        if at is None:
            return
        while len(self.open) > at:
            self.out.append(self.open.pop()[1])
        if name in BLOCKS:
            self.paragraph()


def column_edges(rows: list[list[tuple[int, float | None]]]) -> list[int]:
    """Right edges of a table's columns, from (span, width or none) of each cell of its rows.

    A row that gives each column a width sets their shares; otherwise columns are of one width.
    """
    columns = max(sum(span for span, _ in r) for r in rows)
    said = next(([w for _, w in r] for r in rows if len(r) == columns and all(w for _, w in r)), [1.0] * columns)
    return [round(TABLE_WIDTH * sum(said[: k + 1]) / sum(said)) for k in range(columns)]


class Renderer(Writer):
    """Walks the tags of a text."""

    def __init__(self, text: str):
        super().__init__()
        self.source, self.tags = text, parse(text)
        self.at = 0

    def walk(self, first: int, last: int, end: int) -> None:
        """The tags from ``first`` up to ``last``, and the text up to ``end``."""
        i = first
        while i < last:
            t = self.tags[i]
            self.text(self.source[self.at : t.start])
            self.at = t.end
            rows = self.table_rows(i) if t.name == "table" and t.opens else None
            if rows:
                self.table(rows)
                i, self.at = t.match, self.tags[t.match].end
            elif t.name and t.closing:
                self.end(t.name)
            elif t.name:
                self.start(t.name, t.attributes, t.name in VOID or t.attributes.rstrip().endswith("/"))
            i += 1
        self.text(self.source[self.at : end])
        self.at = end

    def table_rows(self, first: int) -> list[list[tuple[int, int]]] | None:
        """Cells (open, close) of each row of a table that holds rows of cells and no other table, else None."""
        last = self.tags[first].match
        if last < 0 or any(t.name == "table" for t in self.tags[first + 1 : last]) or any(n in HIDDEN for n, _ in self.open):
            return None
        rows = []
        for a, b in children(self.source, self.tags, first, last, "tr", None) or ():
            cells = [children(self.source, self.tags, a, b, name, None) for name in ("td", "th")]
            if None in cells:
                return None
            rows.append(sorted(cells[0] + cells[1]))
        rows = [r for r in rows if r]
        return rows or None

    def table(self, rows: list[list[tuple[int, int]]]) -> None:
        said = lambda t, pattern, none: float(m[1]) if (m := pattern.search(t.attributes)) else none
        model = [[(max(1, min(100, int(said(self.tags[a], SPAN, 1)))), said(self.tags[a], WIDTH, None)) for a, _ in r] for r in rows]
        edges = column_edges(model)
        self.paragraph()
        for row, spans in zip(rows, model, strict=True):
            ends, column = [], 0
            for span, _ in spans:
                column += span
                ends.append(edges[column - 1])
            self.out.append(f"\\trowd\\trgaph{CELL_GAP}" + "".join(f"\\cellx{e}" for e in ends) + "\n")
            for a, b in row:
                self.cell(self.tags[a], a, b)
            self.out.append("\\row\n")
        self.out.append("\\pard\n")
        self.fresh = True

    def cell(self, tag: Tag, first: int, last: int) -> None:
        """A cell's content; elements that are open in it end with it, and its last paragraph has no end of its own."""
        self.out.append("\\intbl ")
        outer, self.open = self.open, []
        self.fresh, self.at, begun = True, tag.end, len(self.out)
        words = ("\\b" if tag.name == "th" else "") + self.style(tag.attributes)
        if words:
            self.out.append("{" + words + " ")
        self.walk(first + 1, last, self.tags[last].start)
        while self.open:
            self.out.append(self.open.pop()[1])
        if len(self.out) > begun and self.out[-1] == "\\par\n":
            self.out.pop()
        self.out.append(("}" if words else "") + "\\cell\n")
        self.open, self.fresh = outer, True


def to_rtf(text: str) -> str:
    w = Renderer(text)
    w.walk(0, len(w.tags), len(text))
    while w.open:
        w.out.append(w.open.pop()[1])
    colours = "".join(f"\\red{r}\\green{g}\\blue{b};" for r, g, b in w.colours)
    return HEAD + (f"{{\\colortbl;{colours}}}" if colours else "") + "\n" + "".join(w.out) + "}"


@F.udf(T.StructType([T.StructField("rtf", T.StringType()), T.StructField("error", T.StringType())]), useArrow=False)
def render(text: str | None) -> tuple[str | None, str | None]:
    """Rows come a hundred at a time, not ten thousand as in Arrow batches, so that a worker never holds many long documents."""
    try:
        return (None if text is None else to_rtf(text), None)
    except Exception as e:  # one bad document must not fail the others
        return (None, type(e).__name__)


def render_rtf(text: Column) -> Column:
    """Struct of ``rtf`` and ``error``, the type of what a document failed with."""
    return render(text)
