"""Visible text of HTML pages with its layout: a tree builder, visibility rules and a renderer."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import session


def _set(names: str) -> frozenset[str]:
    return frozenset(names.split())


VOID = _set("area base br col embed hr img input link meta param source track wbr")
#: Elements whose content is text up to their own end tag; in the second set character references count.
RAW = _set("script style xmp iframe noembed noframes noscript")
RCDATA = _set("title textarea")
#: Never shown, whatever the style says.
UNSEEN = _set(
    "head title script style template noscript iframe noembed noframes datalist video audio canvas "
    "link meta base param source track area"
)
#: Inside a drawing only these hold text that is shown; what others name or define is not.
DRAWN = _set("text foreignobject")
DEFINED = _set("defs desc metadata symbol annotation annotation-xml")
BLOCKS = _set(
    "address article aside body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search section select "
    "summary table ul blockquote xmp caption"
)
#: Blocks set apart from their surroundings by a blank line.
SPACED = _set("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre table figure hr listing xmp fieldset")
LISTS = _set("ul ol menu dir")
CLOSES_P = BLOCKS - _set("body html caption legend")
#: A start tag closes these open elements first, unless one of the second set lies between.
IMPLIED = {
    "li": (_set("li"), _set("ul ol menu dir table")),
    "dt": (_set("dt dd"), _set("dl table")),
    "dd": (_set("dt dd"), _set("dl table")),
    "option": (_set("option"), _set("select datalist")),
    "optgroup": (_set("option optgroup"), _set("select")),
    "td": (_set("td th caption"), _set("table")),
    "th": (_set("td th caption"), _set("table")),
    "tr": (_set("td th tr caption colgroup"), _set("table")),
    "tbody": (_set("td th tr tbody thead tfoot caption colgroup"), _set("table")),
    "thead": (_set("td th tr tbody thead tfoot caption colgroup"), _set("table")),
    "tfoot": (_set("td th tr tbody thead tfoot caption colgroup"), _set("table")),
    "body": (_set("head"), _set("body")),
}
#: End tags reach past these only to close an element of their own kind above them.
SCOPES = _set("table td th caption html template")
HEAD_ONLY = _set("base link meta title style script noscript template")

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    r"|<(?P<junk>[!?][^>]*)(?:>|\Z)"
    r"|<(?P<close>/)?(?P<name>[a-zA-Z][^\s/><]*+)(?P<attrs>(?:[^>\"'<]|\"[^\"]*\"|'[^']*')*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_SPACES = re.compile(r"[ \t\n\r\f]+")
_SIMPLE = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+)*)\Z")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


def build(html: str) -> tuple[Node, list[str]]:
    """The page as a tree, and its style sheets. Start tags imply the ends of what they cannot lie in."""
    root = Node("html", {})
    stack, open_tags, styles = [root], Counter(["html"]), []

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            open_tags[stack.pop().tag] -= 1

    def push(node: Node) -> None:
        stack[-1].children.append(node)
        stack.append(node)
        open_tags[node.tag] += 1

    def close(targets: frozenset[str], barriers: frozenset[str]) -> None:
        """End the outermost of the open ``targets`` this side of a barrier, with all it holds."""
        if not any(open_tags[t] for t in targets):
            return
        found = 0
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in targets:
                found = depth
            elif stack[depth].tag in barriers:
                break
        if found:
            pop_to(found)

    def add_text(text: str) -> None:
        if text:
            if open_tags["head"] and not text.isspace():
                close(_HEAD, frozenset())
            stack[-1].children.append(text)

    at, size = 0, len(html)
    while at < size:
        found = _TOKEN.search(html, at)
        if found is None:
            add_text(unescape(html[at:]))
            break
        add_text(unescape(html[at : found.start()]))
        at = found.end()
        if found["name"] is None:
            continue
        tag = found["name"].lower()
        if found["close"]:
            if tag == "br":
                stack[-1].children.append(Node("br", {}))
            elif tag == "p" and not open_tags["p"]:
                stack[-1].children.append(Node("p", {}))
            elif open_tags[tag] and tag not in ("html", "body"):
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        pop_to(depth)
                        break
                    if stack[depth].tag in SCOPES and tag not in SCOPES and tag not in ("tr", "tbody", "thead", "tfoot"):
                        break
            continue
        attrs = _attributes(found["attrs"]) if found["attrs"].strip(" /\t\n\r\f") else {}
        if tag == "html" or tag == "body" and open_tags["body"]:
            holder = root if tag == "html" else next(n for n in stack if n.tag == "body")
            for name, value in attrs.items():
                holder.attrs.setdefault(name, value)
            continue
        if open_tags["head"] and tag not in HEAD_ONLY and tag != "head":
            close(_HEAD, frozenset())
        if tag in CLOSES_P and open_tags["p"]:
            close(_P, SCOPES)
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            push(Node("tr", {}))
        node = Node(tag, attrs)
        if tag in VOID:
            stack[-1].children.append(node)
            continue
        if tag in RAW or tag in RCDATA:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
            content = html[at : end.start() if end else size]
            at = end.end() if end else size
            stack[-1].children.append(node)
            if tag == "style":
                if not attrs.get("media") or _ON_SCREEN.search(attrs["media"]):
                    styles.append(content)
            else:
                node.children.append(unescape(content) if tag in RCDATA else content)
            continue
        push(node)
    return root, styles


_HEAD, _P = _set("head"), _set("p")


#: Media a style sheet must name to count, if it names any.
_ON_SCREEN = re.compile(r"\b(all|screen)\b", re.I)


def _without_comments(style: str) -> str:
    """A style sheet without ``/* ... */``; one that is not closed reaches to the end."""
    out, at = [], 0
    while (start := style.find("/*", at)) >= 0:
        out.append(style[at:start])
        end = style.find("*/", start + 2)
        at = len(style) if end < 0 else end + 2
    return "".join([*out, style[at:]])


def _plain_rules(style: str) -> Iterator[tuple[str, str]]:
    """Selectors and declarations outside at-rules, in one pass over the braces and semicolons.

    A rule that is not closed reaches to the end, as in browsers.
    """
    at, depth, selectors, skipped = 0, 0, "", False
    for found in re.finditer(r"[{};]", style):
        sign, text = found[0], style[at : found.start()]
        if sign == ";":
            if depth == 0:
                at = found.end()  # an at-rule without a block, or a stray semicolon
            continue
        if sign == "{":
            if depth == 0:
                selectors = text.strip()
                skipped = selectors.startswith("@")
            depth += 1
            if depth == 1:
                at = found.end()
            continue
        if depth == 1 and not skipped:
            yield selectors, text
        depth = max(depth - 1, 0)
        if depth == 0:
            at = found.end()
    if depth == 1 and not skipped:
        yield selectors, style[at:]


def _declared(style: str) -> dict[str, tuple[str, bool]]:
    """Property to value and whether it is important; the last of equally important ones counts."""
    out: dict[str, tuple[str, bool]] = {}
    for declaration in style.lower().split(";"):
        name, colon, value = declaration.partition(":")
        if colon:
            value, mark, _ = value.partition("!important")
            if not (out.get(name.strip(), ("", False))[1] and not mark):
                out[name.strip()] = value.strip(), bool(mark)
    return out


class Rules:
    """Simple selectors that set display, visibility or white space, by the mark or tag they ask for first.

    Rules inside at-rules and selectors with combinators or states are passed over: what cannot be decided
    without laying the page out stays visible.
    """

    def __init__(self, styles: list[str]) -> None:
        self.by_key: dict[str, list[tuple]] = {}
        number = 0
        for style in styles:
            if "display" not in style and "visibility" not in style:
                continue
            for selectors, body in _plain_rules(_without_comments(style)):
                if "display" not in body and "visibility" not in body:
                    continue
                declared = _declared(body)
                for selector in selectors.split(","):
                    simple = _SIMPLE.match(selector.strip())
                    if simple and selector.strip():
                        marks = re.findall(r"[.#][\w-]+", simple[2])
                        tag = "" if simple[1] in (None, "*") else simple[1].lower()
                        ids = sum(m[0] == "#" for m in marks)
                        weight = (ids, len(marks) - ids, bool(tag), number)
                        key = max(marks, key=lambda m: m[0] == "#", default=tag or "*")
                        self.by_key.setdefault(key, []).append((tag, frozenset(marks), weight, declared))
                        number += 1

    def __bool__(self) -> bool:
        return bool(self.by_key)

    def style(self, node: Node) -> dict[str, str]:
        """What applies to a node: important declarations before others, then style attributes, then by specificity and order."""
        attrs = node.attrs
        best: dict[str, tuple] = {}

        def apply(weight: tuple, declared: dict[str, tuple[str, bool]]) -> None:
            for name, (value, important) in declared.items():
                place = (important, *weight)
                if name not in best or place > best[name][0]:
                    best[name] = place, value

        if self.by_key:
            marks = {"." + c for c in attrs.get("class", "").split()}
            if "id" in attrs:
                marks.add("#" + attrs["id"])
            for key in (*marks, node.tag, "*"):
                for tag, wanted, weight, declared in self.by_key.get(key, ()):
                    if (not tag or tag == node.tag) and wanted <= marks:
                        apply((False, *weight), declared)
        if "style" in attrs:
            apply((True,), _declared(attrs["style"]))
        return {name: value for name, (_, value) in best.items()}


class Canvas:
    """Lines of text under construction; white space collapses, margins between blocks merge."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0  # blank lines wanted before the next text
        self.space = False  # a collapsed space waits for the next word
        self.indents: list[str] = []
        self.mark = ""  # list mark for the next line

    def text(self, text: str, keep_space: bool = False) -> None:
        if keep_space:
            first, *more = text.split("\n")
            self._put(first)
            for line in more:
                self.newline(force=True)
                self._put(line)
            return
        words = _SPACES.split(text)
        if len(words) == 1:
            if text:
                self._word(text)
            return
        if words[0]:
            self._word(words[0])
        self.space = True
        inner = " ".join(w for w in words[1:-1] if w)
        if inner:
            self._word(inner)
            self.space = True
        if words[-1]:
            self._word(words[-1])

    def _word(self, word: str) -> None:
        self._put((" " if self.space and self.line else "") + word)
        self.space = False

    def _put(self, text: str) -> None:
        if text:
            if not self.line and self.lines and self.gap:
                self.lines += [""] * self.gap
            self.gap = 0
            self.line.append(text)

    def newline(self, force: bool = False) -> None:
        self.space = False
        if self.line or force:
            indent = "".join(self.indents)
            if self.mark:
                indent = indent[: len(indent) - len(self.mark)] + self.mark if len(indent) >= len(self.mark) else self.mark
                self.mark = ""
            self.lines.append((indent + "".join(self.line)).rstrip())
            self.line = []

    def block(self, spaced: bool) -> None:
        self.newline()
        if spaced:
            self.gap = 1

    def rows(self, rows: list[str]) -> None:
        self.newline()
        for row in rows:
            self._put(row)
            self.newline(force=True)

    def result(self) -> list[str]:
        self.newline()
        return self.lines


class _Busy:
    """Columns that cells from rows above reach into: disjoint stretches, each busy up to a row."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.stretches: list[tuple[int, int, int]] = []

    def free_from(self, at: int, row: int) -> int:
        """The first column from ``at`` on that is free in ``row``."""
        k = max(bisect_right(self.starts, at) - 1, 0)
        while k < len(self.stretches):
            start, end, until = self.stretches[k]
            if start > at:
                break
            if at < end and until > row:
                at = end
            k += 1
        return at

    def take(self, start: int, end: int, until: int, row: int) -> None:
        """Columns ``start`` to ``end`` are busy up to row ``until``; stretches that ended before ``row`` give way."""
        first = max(bisect_right(self.starts, start) - 1, 0)
        last = bisect_left(self.starts, end)
        kept = []
        for a, b, u in self.stretches[first:last]:
            if b <= start or a >= end:
                kept.append((a, b, u))
                continue
            if a < start:
                kept.append((a, start, u))
            if u > until and u > row:
                kept.append((max(a, start), min(b, end), u))
            if b > end:
                kept.append((end, b, u))
        at = start
        for a, b, _ in [k for k in kept if k[0] >= start and k[1] <= end]:
            if a > at:
                kept.append((at, a, until))
            at = b
        if at < end:
            kept.append((at, end, until))
        self.stretches[first:last] = sorted(kept)
        self.starts[first:last] = [a for a, _, _ in self.stretches[first : first + len(kept)]]


class _Sums:
    """Running sums over places whose values grow (a binary indexed tree)."""

    def __init__(self, n: int) -> None:
        self.tree = [0] * (n + 1)

    def add(self, place: int, by: int) -> None:
        place += 1
        while place < len(self.tree):
            self.tree[place] += by
            place += place & -place

    def upto(self, place: int) -> int:
        """The sum of all values before ``place``."""
        total = 0
        while place:
            total += self.tree[place]
            place -= place & -place
        return total


class Table:
    """Cells of an open table, by row; each cell is rendered on a canvas of its own."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.captions: list[str] = []

    def layout(self) -> list[str]:
        """Rows of text in which the cells of a column start at the same place, however wide the table is.

        Columns are only looked at where a cell begins or ends, so large spans cost no more than small ones, and
        each line is put together once. A column's width has the two blanks behind it; one without text has none.
        """
        grid: list[list[tuple[int, list[str]]]] = []
        spans: list[tuple[int, int, int]] = []
        busy = _Busy()
        for r, row in enumerate(self.rows):
            at, cells = 0, []
            for across, down, lines in row:
                at = busy.free_from(at, r)
                cells.append((at, lines))
                spans.append((at, across, max((len(x) for x in lines), default=0)))
                if min(down, len(self.rows) - r) > 1:
                    busy.take(at, at + across, r + down, r)
                at += across
            grid.append(cells)
        columns = sorted({at + across - 1 for at, across, _ in spans})
        widths, sums = dict.fromkeys(columns, 0), _Sums(len(columns))
        for at, across, width in spans:
            if across == 1 and width:
                widths[at] = max(widths[at], width + 2)
        for k, column in enumerate(columns):
            sums.add(k, widths[column])
        for at, across, width in spans:
            if across > 1 and width:
                first, last = bisect_left(columns, at), bisect_left(columns, at + across - 1)
                missing = width + 2 - sums.upto(last + 1) + sums.upto(first)
                if missing > 0:
                    widths[columns[last]] += missing
                    sums.add(last, missing)
        filled = [c for c in columns if widths[c]]
        places = [0]
        for column in filled:
            places.append(places[-1] + widths[column])
        out = list(self.captions)
        for cells in grid:
            left, k = [(places[bisect_left(filled, at)], lines) for at, lines in cells], 0
            while left := [c for c in left if k < len(c[1])]:
                line, length = [], 0
                for place, lines in left:
                    if lines[k]:
                        line += " " * (place - length), lines[k]
                        length = place + len(lines[k])
                out.append("".join(line).rstrip())
                k += 1
        return out


def _span(node: Node, name: str) -> int:
    value = node.attrs.get(name, "1").strip()
    return min(max(int(value), 1), 1000) if value.isascii() and value.isdigit() and len(value) < 6 else 1


def render(html: str | None) -> str:
    """All visible text of a page. Empty and null pages give an empty text.

    Blocks start on lines of their own, paragraphs, headings, lists and tables are set apart by a blank line,
    list items have a bullet or number and are indented by depth, preformatted text keeps its white space, and table
    cells are padded so that columns align. Hidden are the ``hidden`` attribute, ``display: none`` and
    ``visibility: hidden`` from style attributes and simple style rules by importance, specificity and order (sheets
    for other media than the screen do not count), what a closed ``details`` holds beside its summary, and elements
    that are never shown. Formulas, the text of drawings, options and the fallback of objects are shown.
    The tree is walked with a stack of its own, so nesting may be of any depth. Time and memory grow about with the page
    and its text, which is longer than the page where short cells stand beside wide columns.
    """
    if not html:
        return ""
    root, styles = build(html.replace("\r\n", "\n").replace("\r", "\n").replace("\0", ""))
    rules = Rules(styles)
    canvas = Canvas()
    canvases: list[Canvas] = []
    tables: list[Table] = []
    counters: list[int | None] = []  # number of the next item by open list; None: bullets
    work: list[tuple] = [(root, True, False, False)]  # (node or text, visible, preformatted, leaving)
    while work:
        node, visible, pre, leaving = work.pop()
        if isinstance(node, str):
            if visible:
                canvas.text(node.replace("\xa0", "\x01") if pre else node, pre)
            continue
        tag = node.tag
        if leaving:
            if tag in ("td", "th", "caption") and tables and canvases:
                lines = canvas.result()
                canvas = canvases.pop()
                if tag == "caption":
                    tables[-1].captions += lines
                else:
                    if not tables[-1].rows:
                        tables[-1].rows.append([])
                    tables[-1].rows[-1].append((_span(node, "colspan"), _span(node, "rowspan"), lines))
            elif tag == "table":
                canvas.block(True)
                canvas.rows(tables.pop().layout())
                canvas.block(True)
            elif tag in BLOCKS:
                canvas.newline()
                if tag in LISTS:
                    counters.pop()
                if tag in ("li", "blockquote", "dd") and canvas.indents:
                    canvas.indents.pop()
                    canvas.mark = ""
                canvas.block(tag in SPACED and not (tag in LISTS and counters))
            continue
        if tag in UNSEEN or tag in DEFINED or "hidden" in node.attrs:
            continue
        style = rules.style(node) if rules or "style" in node.attrs else {}
        if style.get("display") == "none" or tag == "dialog" and "open" not in node.attrs:
            continue
        seen = style.get("visibility")
        if seen in ("visible", "hidden", "collapse") and visible is not None:
            visible = seen == "visible"
        if tag == "svg" and visible:
            visible = None  # shown, but only where a drawing holds text
        elif visible is None and tag in DRAWN:
            visible = True
        if tag == "br":
            canvas.newline(force=bool(visible))
            continue
        if tag == "table":
            canvas.block(True)
            tables.append(Table())
        elif tag == "tr" and tables:
            tables[-1].rows.append([])
        elif tag in ("td", "th", "caption") and tables:
            canvases.append(canvas)
            canvas = Canvas()
        elif tag in BLOCKS:
            canvas.block(tag in SPACED and not (tag in LISTS and counters))
            if tag in LISTS:
                start = node.attrs.get("start", "1").strip()
                counters.append((int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1) if tag == "ol" else None)
            elif tag == "li":
                mark = "* "
                if counters and counters[-1] is not None:
                    mark = f"{counters[-1]}. "
                    counters[-1] += 1
                canvas.indents.append(" " * len(mark))
                canvas.mark = mark if visible else ""
            elif tag in ("blockquote", "dd"):
                canvas.indents.append("    ")
        elif tag == "img":
            continue
        pre = pre or tag in ("pre", "textarea", "listing", "xmp") or style.get("white-space", "").startswith("pre")
        work.append((node, visible, pre, True))
        children = node.children
        if tag == "details" and "open" not in node.attrs:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        work.extend((child, visible, pre, False) for child in reversed(children))
    lines = canvas.result()
    while canvases:  # cells left open by the page's end
        lines = canvases.pop().result() + lines
    text = "\n".join(line.replace("\xa0", " ").replace("\x01", " ").rstrip() for line in lines)
    return re.sub(r"\n{3,}", "\n\n", text).strip("\n")


#: Characters of text after which a worker hands on what it has of a batch: padded tables are longer than their pages.
HANDED_ON = 8_000_000
RENDERED = "struct<text: string, n_lines: long>"


def rendered(html: Column) -> Column:
    """``render`` as a column, with the number of lines: counted here, the text need not be copied for it."""
    @F.arrow_udf(RENDERED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def struct(texts: list[str]) -> pa.Array:
            n_lines = pa.array([text.count("\n") + 1 if text else 0 for text in texts], pa.int64())
            return pa.StructArray.from_arrays([pa.array(texts, pa.string()), n_lines], ["text", "n_lines"])

        for batch in batches:
            texts, n_chars = [], 0
            for page in batch:
                texts.append(render(page.as_py()))
                n_chars += len(texts[-1])
                if n_chars > HANDED_ON:
                    yield struct(texts)
                    texts, n_chars = [], 0
            yield struct(texts)

    return run(html)


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id, text, n_chars, n_lines`` per row of ``pages``.

    A null page is empty and gives an empty text, a null id is carried along, repeated rows stay, an empty table
    gives no rows, other columns are ignored. Pages are read whole; broken markup never fails. A text over 2 GB, as a
    table of many rows beside a very wide column may give, is more than a Spark value holds, and fails.
    """
    session(pages.sparkSession)
    found = pages.select(F.col(id_col).alias("page_id"), rendered(F.col(html_col)).alias("found"))
    return found.select("page_id", "found.text", F.length("found.text").cast("long").alias("n_chars"), "found.n_lines")
