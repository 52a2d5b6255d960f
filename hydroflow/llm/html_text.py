"""HTML extraction by layout-aware rendering.

A tokenizer feeds a tree builder that supplies implied end tags (a new ``<li>`` ends the open one, a block ends an open
paragraph, a cell ends a cell) and closes what is still open at the end. Rendering walks the tree without recursion:
invisible subtrees are left out, blocks start new lines and keep one blank line where the layout has a margin, lists
are marked and indented, ``<pre>`` keeps its blanks, and tables are laid out with their columns aligned. All other
visible text comes out in reading order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydroflow.llm.common import fresh, text_or_empty

# Element names of the HTML standard, by what they do to layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INVISIBLE = frozenset(
    "annotation annotation-xml audio canvas datalist head iframe link meta noembed noframes object script style svg template title video".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul caption".split()
)
MARGIN = frozenset("blockquote dl fieldset figure form h1 h2 h3 h4 h5 h6 hr ol p pre table ul menu dir".split())
ENDS_PARAGRAPH = BLOCK - frozenset("body html li dd dt option optgroup tbody td tfoot th thead tr caption legend summary".split())
# A start tag of the key ends the open elements named, up to one of the barriers.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
}
# An end tag does not reach past these.
SCOPE = frozenset({"table", "td", "th", "caption"})

_BLANKS = re.compile(r"[ \t\n\r\f]+")
_HIDDEN_STYLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.IGNORECASE)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """Text is collected as strings among the children; comments and declarations are left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        # How many of each element are open, so that looking for one that is not there costs nothing.
        self.count: dict[str, int] = {}

    def _pop(self) -> None:
        self.count[self.open.pop().tag] -= 1

    def _end(self, names: set[str] | frozenset[str], barriers: set[str] | frozenset[str]) -> None:
        """Close the nearest open element of ``names`` and all inside it, unless a barrier comes first; again while it works."""
        while any(self.count.get(n) for n in names):
            for at in range(len(self.open) - 1, 0, -1):
                tag = self.open[at].tag
                if tag in names:
                    while len(self.open) > at:
                        self._pop()
                    break
                if tag in barriers:
                    return
            else:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body") and self.count.get(tag):
            return
        if tag in IMPLIED:
            self._end(*IMPLIED[tag])
        if tag in ENDS_PARAGRAPH and self.count.get("p"):
            self._end({"p"}, SCOPE)
        if self.count.get("head") and tag not in INVISIBLE and tag not in ("base", "html", "noscript"):
            self._end({"head"}, set())
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        # In HTML the slash means nothing, except inside drawings and formulas.
        if tag not in VOID and (self.count.get("svg") or self.count.get("math")) and self.open[-1].tag == tag:
            self._pop()

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].children.append(Node("br", {}))
        elif tag == "p" and not self.count.get("p"):
            self.open[-1].children.append(Node("p", {}))
        elif self.count.get(tag) and tag not in ("body", "html"):
            barriers = SCOPE - {tag} if tag not in ("table", "tr", "tbody", "thead", "tfoot") else {"table"} - {tag}
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag == tag:
                    while len(self.open) > at:
                        self._pop()
                    break
                if self.open[at].tag in barriers:
                    break

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def is_hidden(node: Node) -> bool:
    attrs = node.attrs
    return (
        node.tag in INVISIBLE
        or "hidden" in attrs
        or (node.tag == "dialog" and "open" not in attrs)
        or (node.tag == "input" and (attrs.get("type") or "").lower() == "hidden")
        or bool(attrs.get("style") and _HIDDEN_STYLE.search(attrs["style"]))
    )


class Lines:
    """Text laid out line by line: ``gap`` is how many line ends are due before the next text."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.line: list[str] = []
        self.gap, self.blank = 0, False
        self.marks: list[str] = []

    def _flush(self) -> None:
        if self.line:
            self.out.append("".join(self.line).rstrip(" "))
            self.line = []
        self.blank = False

    def block(self, margin: bool) -> None:
        self._flush()
        self.gap = max(self.gap, 2 if margin else 1)

    def break_(self) -> None:
        if self.line:
            self._flush()
        else:
            self.gap = max(self.gap, 2)

    def _open(self, indent: str) -> None:
        if not self.line:
            if self.out and self.gap > 1:
                self.out.append("")
            self.gap = 0
            self.line.append(indent)
            if self.marks:
                self.line.append(" ".join(self.marks) + " ")
                self.marks = []
            self.blank = True

    def text(self, data: str, indent: str) -> None:
        words = _BLANKS.sub(" ", data)
        if not words.strip(" "):
            self.blank_after(words)
            return
        starts = not self.line
        self._open(indent)
        if words[0] == " " and not starts and not self.blank:
            self.line.append(" ")
        self.line.append(words.strip(" "))
        self.blank = False
        self.blank_after(words[-1])

    def blank_after(self, words: str) -> None:
        if words.endswith(" ") and self.line and not self.blank:
            self.line.append(" ")
            self.blank = True

    def raw(self, data: str, indent: str) -> None:
        for i, part in enumerate(data.replace("\r\n", "\n").split("\n")):
            if i:
                if not self.line:
                    self.out.append("")
                self._flush()
            if part:
                self._open(indent)
                self.line.append(part)
                self.blank = False

    def done(self) -> str:
        self._flush()
        return "\n".join(self.out)


def _int(value: str | None, default: int) -> int:
    return int(value) if value and value.strip().isdecimal() and len(value.strip()) < 10 else default


class _Table:
    """Rows of a table that is being rendered; each cell has its own lines."""

    def __init__(self, outer: Lines, indent: str):
        self.outer, self.indent = outer, indent
        self.rows: list[list[str]] = []
        self.captions: list[str] = []

    def laid_out(self) -> list[str]:
        wide = max((len(r) for r in self.rows), default=0)
        cells = [[c.split("\n") for c in r] for r in self.rows if any(r)]
        widths = [max((len(x) for r in cells if i < len(r) for x in r[i]), default=0) for i in range(wide)]
        lines = list(self.captions)
        for row in cells:
            for k in range(max(len(c) for c in row)):
                parts = [(c[k] if k < len(c) else "").ljust(widths[i]) for i, c in enumerate(row)]
                lines.append(" | ".join(parts).rstrip(" "))
        return lines


def render(root: Node) -> str:
    """The visible text of a tree. An explicit stack holds, per step, a node to enter or a function that ends it."""
    lines = Lines()
    tables: list[_Table] = []
    lists: list[tuple[str, int]] = []
    stack: list = [(root, "", False)]

    def end_block(margin: bool):
        return lambda: lines.block(margin)

    while stack:
        step = stack.pop()
        if callable(step):
            step()
            continue
        node, indent, pre = step
        if isinstance(node, str):
            lines.raw(node, indent) if pre else lines.text(node, indent)
            continue
        if is_hidden(node):
            continue
        tag, inner = node.tag, indent
        if tag == "br":
            lines.break_()
            continue
        if tag in ("img", "input", "area"):
            shown = node.attrs.get("alt") if tag != "input" else node.attrs.get("value")
            if shown and (tag != "input" or (node.attrs.get("type") or "text").lower() in ("text", "submit", "button", "reset", "search")):
                lines.text(f" {shown} ", indent)
            continue
        if tag == "hr":
            lines.block(True)
            continue
        if tag == "table":
            lines.block(True)
            own = _Table(lines, indent)
            tables.append(own)

            def end_table(own=own, lines_before=lines, indent=indent):
                nonlocal lines
                tables.pop()
                # Text that got into no cell stands before the table.
                loose, lines = lines.done(), lines_before
                for text in loose.split("\n") if loose else ():
                    lines._open("")
                    lines.line.append(text)
                    lines.block(False)
                for text in own.laid_out():
                    lines._open(indent)
                    lines.line.append(text)
                    lines.block(False)
                lines.block(True)

            lines = Lines()
            stack.append(end_table)
        elif tag == "tr" and tables:
            tables[-1].rows.append([])
        elif tag in ("td", "th", "caption") and tables:
            if tag != "caption" and not tables[-1].rows:
                tables[-1].rows.append([])
            row = tables[-1].rows[-1] if tag != "caption" else tables[-1].captions

            def end_cell(row=row, lines_before=lines, span=_int(node.attrs.get("colspan"), 1), caption=tag == "caption"):
                nonlocal lines
                row.append(lines.done())
                if not caption:
                    row.extend([""] * (min(span, 1000) - 1))
                lines = lines_before

            lines = Lines()
            stack.append(end_cell)
            inner = ""
        elif tag in BLOCK:
            margin = tag in MARGIN and not (tag in ("ul", "ol", "menu", "dir") and lists)
            lines.block(margin)
            stack.append(end_block(margin))
            if tag in ("ul", "ol", "menu", "dir"):
                lists.append((tag, _int(node.attrs.get("start"), 1)))
                stack.append(lambda: lists.pop() and None)
                inner = indent + "  " if len(lists) > 1 else indent
            elif tag == "li":
                kind, number = lists[-1] if lists else ("ul", 1)
                number = _int(node.attrs.get("value"), number)
                lines.marks.append(f"{number}." if kind == "ol" else "-")
                if lists:
                    lists[-1] = (kind, number + 1)
                # A mark whose item has no text is dropped.
                stack.append(lambda lines=lines: lines.marks.clear())
            elif tag == "blockquote" or tag == "dd":
                inner = indent + "  "
        elif tag == "q":
            lines.text('"', indent)
            stack.append(('"', indent, False))
        children = node.children
        if tables and tag in ("table", "tr", "thead", "tbody", "tfoot"):
            # What is directly in a table stands before it in browsers; here it joins the row as a cell of its own.
            children = _in_cells(children)
        stack.extend((child, inner, pre or tag in ("pre", "textarea", "listing", "xmp")) for child in reversed(children))
    return lines.done()


TABLE_PARTS = frozenset("tr td th caption thead tbody tfoot".split())


def _holds(child: Node | str) -> tuple[bool, bool]:
    """Whether there may be something to see in a child of a table, and whether it holds parts of that table."""
    shows, stack = False, [child]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            shows = shows or bool(node.strip())
        elif not is_hidden(node):
            if node.tag in TABLE_PARTS:
                return True, True
            shows = shows or node.tag in ("img", "input", "area", "q", "table")
            if node.tag != "table":
                stack.extend(node.children)
    return shows, False


def _in_cells(children: list[Node | str]) -> list[Node | str]:
    """The children with each run of those that are no parts of a table put into a cell, if it shows anything."""
    out: list[Node | str] = []
    run: list[Node | str] = []
    shown = False

    def end_run() -> None:
        nonlocal run, shown
        if shown:
            cell = Node("td", {})
            cell.children = run
            out.append(cell)
        else:
            out.extend(run)
        run, shown = [], False

    for child in children:
        shows, parts = _holds(child)
        if parts:
            end_run()
            out.append(child)
        else:
            run.append(child)
            shown = shown or shows
    end_run()
    return out


def extract(html: str) -> str:
    """The visible text of a page; of a page without tags its text, of an empty one nothing."""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return render(builder.root)


def extract_text(df: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """Add the visible text of each page. NULL pages count as empty; malformed markup is read as far as it goes.

    Rows and other columns stay as they are; if the frame has a column called ``into``, the new one gets a leading
    underscore.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([extract(page) for page in batch], dtype=object)

    shown: Column = F.pandas_udf(run, "string")(text_or_empty(html))
    return df.withColumn(fresh(df, into), shown)
