"""HTML extraction by layout-aware rendering.

``tree_events`` builds the element tree as a browser would (void elements,
implied end tags, implied table rows, scopes of end tags) and gives it as a
stream of open, text and close events; ``render`` lays the visible text out:
blocks on lines of their own with blank lines where blocks have margins, lists
indented with their markers, preformatted text as it is, and table cells
aligned in columns (spans included).  Text and elements of a table that are in
none of its cells or captions come before it, as in a browser, with the style
of what holds the table; there only white space is dropped.

Hidden are elements that are never shown (scripts, styles, templates, the
head, option lists of inputs, and in svg and math what they only define or
describe), the ``hidden`` attribute, and inline ``display: none`` and
``visibility: hidden``, the content of a ``details`` that isn't open but for
its first summary, and a ``dialog`` that isn't open.  The page is taken as seen with scripts, frames, audio
and video, whose stand-in texts (noscript, noframes, inside iframe, audio and
video) are hidden; objects and canvases are not drawn, so theirs are shown.

Each page is a row of its own: one pass, no shuffle, a page in memory at a
time.  There is no recursion, and time and output grow with the page, not with
its depth: where an unclosed tag would end is looked up, the innermost open
element of a name is kept by name, and lines are indented by ``MAX_INDENT``
columns at most.  Only tables inside of tables cost their lines once a level.

Defined results: null and empty html give an empty text; broken markup is
repaired as above; repeated rows get equal texts; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import batch_of


def _set(names: str) -> frozenset[str]:
    return frozenset(names.split())


# Kinds of elements.
VOID = _set("area base br col embed hr img input link meta param source track wbr")
RAW = _set("script style xmp iframe noembed noframes textarea title noscript")
HIDDEN = _set("head script style template noscript iframe noembed noframes title datalist audio video")
# Content of svg and math: never shown there, set apart from its neighbours, tags that end it, elements in which html goes on.
HIDDEN_IN = _set("defs desc metadata symbol clippath mask pattern marker annotation annotation-xml")
APART_IN = _set("text mtr mtd")
FOREIGN = _set("svg math")
LEAVES_FOREIGN = _set("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
                      "pre ruby s small span strong strike sub sup table tt u ul var")
HTML_IN_FOREIGN = _set("foreignobject desc title annotation-xml mi mo mn ms mtext")
IN_HEAD = _set("base link meta noscript script style template title")
BLOCK = _set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
             "form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre search section summary table ul")
MARGIN = _set("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul")
CLOSES_P = BLOCK - _set("body html caption legend option optgroup") | {"hr", "xmp"}
HEADINGS = _set("h1 h2 h3 h4 h5 h6")
LISTS = _set("ul ol menu dir")
SECTIONS = _set("thead tbody tfoot")
TABLE_PARTS = _set("caption colgroup thead tbody tfoot tr td th")
BETWEEN = SECTIONS | {"table", "colgroup", "tr"}  # what is directly in these stands before the table
# The parent that a table part has; what is open inside of it ends.
PART_OF = {"tr": SECTIONS | {"table"}} | dict.fromkeys(("td", "th"), SECTIONS | {"table", "tr"})
# What a start tag ends, and the elements that it doesn't look beyond.
ENDS = {"li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
        "optgroup": ({"option", "optgroup"}, {"select"}), "tr": ({"tr", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"})} | dict.fromkeys([*SECTIONS, "caption", "colgroup"], (SECTIONS | {"caption", "colgroup"}, {"table"}))
SCOPE = _set("table td th caption button object template html")
SPACE = " \t\n\f\r"

TOKEN = re.compile(r"<!--(?:.*?--!?>|.*\Z)|<[!?]|</?[a-zA-Z]", re.S)  # a comment, or how a tag begins
TAG_END = re.compile(r"""(?:[^>"']++|"[^"]*"|'[^']*')*+>""")
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
WORD = re.compile(r"[^ \t\n\f\r]+")
MAX_INDENT = 64  # columns
NEAR = 12  # open elements that are looked at one by one


def _attributes(tag: str, name: str) -> dict[str, str]:
    if len(tag) <= len(name) + 3:
        return {}
    found = {}
    for key, value in ATTRIBUTE.findall(tag[len(name) + 1:-1]):
        found.setdefault(key.lower(), html.unescape(value[1:-1] if value[:1] in ("'", '"') else value))
    return found


class TagEnds:
    """Where the tags of a page end: at the first ``>`` that is in no quotes."""

    def __init__(self, page: str):
        self.page, self.marks, self.ends = page, None, None

    def after(self, at: int) -> int:
        """The end of the tag that is open at a place; -1: it has none."""
        if self.marks is None:
            if m := TAG_END.match(self.page, at):
                return m.end()
            self._prepare()
        k = bisect_left(self.marks, at)
        return self.ends[k] if k < len(self.marks) else -1

    def _prepare(self) -> None:
        """The ends from each ``>`` and quote on, from the last to the first; once
        a page, as each tag without an end would be read to the end of the page."""
        self.marks = [m.start() for m in re.finditer("[>\"']", self.page)]
        self.ends, following = [-1] * len(self.marks), {}
        for k in range(len(self.marks) - 1, -1, -1):
            mark = self.page[self.marks[k]]
            if mark == ">":
                self.ends[k] = self.marks[k] + 1
            else:
                closing = following.get(mark, len(self.marks))
                self.ends[k] = self.ends[closing + 1] if closing + 1 < len(self.marks) else -1
                following[mark] = k


def tree_events(page: str):
    """("open", name, attributes), ("text", string) and ("close", name) of the element tree."""
    stack: list[str] = []
    depths: dict[str, list[int]] = {}  # of the open elements by name
    foreign = 0  # open svg and math elements
    ends, last_end = TagEnds(page), page.rfind(">")

    def close_to(depth):
        nonlocal foreign
        while len(stack) > depth:
            name = stack.pop()
            depths[name].pop()
            foreign -= name in FOREIGN
            yield "close", name

    def innermost(names) -> int:
        return max((depths[n][-1] for n in names if depths.get(n)), default=-1)

    def last(names, beyond) -> int:
        """Depth of the innermost of the names, not beyond others; -1: none."""
        for k in range(len(stack) - 1, max(len(stack) - NEAR, 0) - 1, -1):
            if stack[k] in names:
                return k
            if stack[k] in beyond:
                return -1
        k = innermost(names) if len(stack) > NEAR else -1
        return k if k >= 0 and k >= innermost(beyond) else -1

    def opened(name, attributes):
        nonlocal foreign
        foreign += name in FOREIGN
        depths.setdefault(name, []).append(len(stack))
        stack.append(name)
        return "open", name, attributes

    def start(name, tag):
        if stack and stack[-1] == "head" and name not in IN_HEAD:
            yield from close_to(len(stack) - 1)
        if name in ("html", "body", "head") and (depths.get(name) or depths.get("body")):
            return
        while foreign and name in LEAVES_FOREIGN and (k := last(FOREIGN, HTML_IN_FOREIGN)) >= 0:
            yield from close_to(k)
        if name == "table" and (k := last({"table"}, {"td", "th", "caption", "template"})) >= 0:
            yield from close_to(k)  # only a cell or caption holds another table
        if name in CLOSES_P and (k := last({"p"}, SCOPE)) >= 0:
            yield from close_to(k)
        if name in HEADINGS and stack and stack[-1] in HEADINGS:
            yield from close_to(len(stack) - 1)
        if name in TABLE_PARTS and last({"table"}, ()) < 0:
            return  # table parts outside a table are ignored
        if name in ENDS and (k := last(*ENDS[name])) >= 0:
            yield from close_to(k)
        if name in TABLE_PARTS:
            yield from close_to(last(PART_OF.get(name, {"table"}), ()) + 1)
            if name in ("td", "th") and stack[-1] != "tr":
                yield opened("tr", {})
        if name in VOID:
            yield "open", name, _attributes(tag, name)
            yield "close", name
        else:
            alone = foreign and tag.endswith("/>") and (name in FOREIGN or last(FOREIGN, HTML_IN_FOREIGN) >= 0)
            yield opened(name, _attributes(tag, name))
            if alone or name in FOREIGN and tag.endswith("/>"):
                yield from close_to(len(stack) - 1)

    def end(name):
        if name == "br":
            yield "open", "br", {}
            yield "close", "br"
        elif name == "p" and last({"p"}, SCOPE) < 0:
            yield "open", "p", {}
            yield "close", "p"
        elif name not in VOID and name not in ("html", "body"):
            names = HEADINGS if name in HEADINGS else {name}
            beyond = {"table"} if name in TABLE_PARTS else () if name == "table" else LISTS | SCOPE if name == "li" else SCOPE
            if (k := last(names, beyond - names if beyond else ())) >= 0:
                yield from close_to(k)

    at, raw = 0, ""
    while at < len(page):
        if raw:  # nothing but its own end tag ends it
            m = re.compile(rf"</{raw}(?=[\s/>])", re.I).search(page, at)
            close = page.find(">", m.end()) if m else -1
            stop = m.start() if close >= 0 else len(page)
            yield "text", (html.unescape(page[at:stop]) if raw in ("textarea", "title") else page[at:stop])
            at = close + 1 if close >= 0 else len(page)
            raw = ""
            yield from close_to(len(stack) - 1)
            continue
        m, close = TOKEN.search(page, at), -1
        while m:
            close = m.end() if m[0][:4] == "<!--" else ends.after(m.end()) if m[0][1] not in "!?" \
                else page.find(">", m.end()) + 1 if m.end() <= last_end else -1
            if close >= 0:
                break
            m = TOKEN.search(page, m.start() + 1)  # never ended: text
        stop = m.start() if m else len(page)
        if stop > at:
            text = html.unescape(page[at:stop])
            if stack and stack[-1] == "head" and text.strip(SPACE):
                yield from close_to(len(stack) - 1)
            yield "text", text
        if not m:
            break
        at, tag = close, page[stop:close]
        if tag[1] in "!?":
            continue
        name = NAME.match(tag)[1].lower()
        if tag[1] == "/":
            yield from end(name)
        else:
            depth = len(stack)
            yield from start(name, tag)
            if name in RAW and stack[-1:] == [name] and (len(stack) > depth or depth):
                raw = name
    yield from close_to(0)


class Flow:
    """Lines of text laid out so far."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the line begun
        self.gap, self.margin, self.pre = False, False, 0
        self.visible = False  # something other than white space is on the line
        self.indents: list[str] = []  # of a first line: list markers, or white space
        self.columns = [0]  # sums of their widths
        self.begun = 0  # indents whose first line has begun
        self.blanks = False  # some line ends with blanks
        self._open = False

    def indent(self, first: str) -> None:
        self.indents.append(first)
        self.columns.append(self.columns[-1] + len(first))

    def outdent(self) -> None:
        self.indents.pop()
        self.columns.pop()
        self.begun = min(self.begun, len(self.indents))

    def _add(self, part: str) -> None:
        self.parts.append(part)
        self.visible = self.visible or not part.isspace()

    def text(self, text: str) -> None:
        if self.pre:
            for k, part in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
                if k:
                    self.newline()
                if part:
                    self.begin()
                    self._add(part)
            return
        words = WORD.findall(text)
        if words:
            if text[0] in SPACE:
                self.gap = True
            if self.visible and self.gap and self._open:
                self.parts.append(" ")
            else:
                self.begin()
            self._add(" ".join(words))
            self.gap = text[-1] in SPACE
        elif text:
            self.gap = True

    def begin(self) -> None:
        if self._open:
            return
        if self.margin and self.lines:
            self.lines.append("")
        self.margin, self._open = False, True
        if self.indents:
            self.parts.append(" " * min(self.columns[self.begun], MAX_INDENT))
            for first, end in zip(self.indents[self.begun:], self.columns[self.begun + 1:]):
                if end <= MAX_INDENT or not first.isspace():  # markers are text
                    self._add(first)
            self.begun = len(self.indents)

    def finish_line(self, trim: bool = False) -> None:
        if self._open:
            line = "".join(self.parts)
            self.lines.append(line if self.pre and not trim else line.rstrip(" "))
            self.blanks |= self.lines[-1][-1:] == " "
        self.parts, self.visible, self._open, self.gap = [], False, False, False

    def newline(self) -> None:
        empty = not self._open
        self.begin()
        self.finish_line(trim=empty)

    def block(self, margin: bool) -> None:
        self.finish_line()
        self.margin |= margin

    def verbatim(self, lines: list[str]) -> None:
        """Lines that are laid out already."""
        self.block(True)
        self.pre += 1
        for line in lines[:1]:
            self.text(line)
            self.newline()
        self.pre -= 1
        indent = " " * min(self.columns[-1], MAX_INDENT)
        self.lines += [line and indent + line for line in lines[1:]] if indent else lines[1:]
        self.block(True)

    def result(self) -> list[str]:
        self.finish_line()
        return self.lines


def width(text: str) -> int:
    """Columns that a line takes."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Table:
    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.caption: list[str] = []
        self.blanks = False  # some line of a cell ends with blanks

    def laid_out(self) -> list[str]:
        if not self.caption and not self.blanks and len(self.rows) == 1 == len(self.rows[0]):
            return self.rows[0][0][0]  # one cell: its lines
        grid, taken = [], {}  # taken: column -> rows that a span from above still covers
        for row in self.rows:
            placed, column, below = [], 0, {c: n - 1 for c, n in taken.items() if n > 1}
            for lines, across, down in row:
                while column in taken:
                    column += 1
                placed.append((column, across, lines))
                below |= {c: down - 1 for c in range(column, column + across) if down > 1}
                column += across
            grid.append(placed)
            taken = below
        widths: dict[int, int] = {}
        for column, across, lines in sorted((c for row in grid for c in row), key=lambda c: c[1]):
            need = max(map(width, lines), default=0) - sum(widths.get(c, 0) + 2 for c in range(column, column + across - 1))
            widths[column + across - 1] = max(widths.get(column + across - 1, 0), need, 0)
        starts, at = {}, 0
        for column in range(max(widths, default=-1) + 1):
            starts[column] = at
            at += widths[column] + 2 if widths.get(column) else 0
        out = list(self.caption)
        for placed in grid:
            for k in range(max((len(lines) for _, _, lines in placed), default=0)):
                line = ""
                for column, _, lines in placed:
                    if k < len(lines) and lines[k]:
                        line += " " * max(starts[column] - width(line), 2 if line else 0) + lines[k]
                out.append(line.rstrip(" "))
        return out


def _whole(text: str | None, low: int, high: int) -> int | None:
    m = re.match(r"\s*(-?[0-9]{1,9})", text or "")
    return max(low, min(high, int(m[1]))) if m else None


def render(page: str | None) -> tuple[str, int, int, int]:
    """(visible text, lines, list items, tables)."""
    flows, tables, items, n_tables = [Flow()], [], 0, 0
    elements: list[tuple] = []  # (shown, displayed, numbering or span or what a closed details has shown, name)
    lists: list[list] = []  # [kind, number] of the open ones
    foreign = 0  # open svg and math elements
    for event, *rest in tree_events(page or ""):
        shown, displayed = elements[-1][:2] if elements else (True, True)
        flow = flows[-1]
        name = rest[0]
        between = event != "close" and bool(elements) and elements[-1][3] in BETWEEN and (event == "text" or name not in TABLE_PARTS)
        if between:  # not in a cell: in the flow and with the style of what holds the table
            k = len(elements) - 1
            while k and elements[k][3] != "table":
                k -= 1
            shown, displayed = elements[k - 1][:2] if k else (True, True)
        if event == "text":
            if shown and displayed and not (between and not name.strip(SPACE)) and not (elements and isinstance(elements[-1][2], dict)):
                flow.text(name)
            continue
        inner = foreign > 0
        if name in FOREIGN:
            foreign += 1 if event == "open" else -1
        if event == "open":
            attributes, numbering = rest[1], None
            style = attributes.get("style", "").lower().replace(" ", "") if attributes else ""
            displayed = displayed and name not in HIDDEN and not (inner and name in HIDDEN_IN) and "hidden" not in attributes and "display:none" not in style
            displayed = displayed and not (name == "dialog" and "open" not in attributes)
            if elements and isinstance(elements[-1][2], dict):  # a details that isn't open shows its first summary
                displayed = displayed and name == "summary" and not elements[-1][2]["summary"]
                elements[-1][2]["summary"] |= name == "summary"
            if name == "details" and "open" not in attributes:
                numbering = {"summary": False}
            shown = "visibility:visible" in style or shown and "visibility:hidden" not in style and "visibility:collapse" not in style
            if displayed:
                if name == "br":
                    flow.newline()
                elif name == "table":
                    tables.append(Table())
                    n_tables += 1
                elif name == "tr":
                    tables[-1].rows.append([])
                elif name in ("td", "th"):
                    numbering = (_whole(attributes.get("colspan"), 1, 1000) or 1, _whole(attributes.get("rowspan"), 0, 65534))
                    flows.append(Flow())
                elif name == "caption" and tables:
                    flows.append(Flow())
                elif inner and name in APART_IN:
                    flow.gap = True
                elif name in BLOCK or name == "hr":
                    flow.block(name in MARGIN and not (name in LISTS and lists))
                    if name in LISTS:
                        numbering = ["ol" if name == "ol" else "ul", _whole(attributes.get("start"), -10**9, 10**9) if "start" in attributes else 1]
                        numbering[1] = 1 if numbering[1] is None else numbering[1]
                        lists.append(numbering)
                    elif name == "li":
                        items += 1
                        of = lists[-1] if lists else ["ul", 1]
                        number = _whole(attributes.get("value"), -10**9, 10**9) if "value" in attributes else None
                        of[1] = of[1] if number is None else number
                        mark = f"{of[1]}. " if of[0] == "ol" else "- "
                        of[1] += 1
                        flow.indent(mark)
                    elif name in ("blockquote", "dd"):
                        flow.indent("  ")
                    elif name == "pre":
                        flow.pre += 1
            elements.append((shown, displayed, numbering, name))
            continue
        _, displayed, numbering, _ = elements.pop()
        if not displayed:
            continue
        if name in ("td", "th"):
            cell = flows.pop()
            lines = cell.result()
            tables[-1].blanks |= cell.blanks
            tables[-1].rows[-1].append((lines, numbering[0], 1 if numbering[1] is None else numbering[1] or 65534))
        elif name == "caption" and tables:
            tables[-1].caption += flows.pop().result()
        elif name == "table":
            flow.verbatim(tables.pop().laid_out())
        elif inner and name in APART_IN:
            flow.gap = True
        elif name in BLOCK:
            if name in LISTS:
                lists.pop()
            if name == "li" and flow.begun < len(flow.indents):
                flow.begin()  # an empty item is its marker
            if name == "pre":
                flow.finish_line()
                flow.pre -= 1
            flow.block(name in MARGIN and not (name in LISTS and lists))
            if name in ("li", "blockquote", "dd"):
                flow.outdent()
    lines = flows[0].result()
    return "\n".join(lines), len(lines), items, n_tables


def rendered_pages(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per page: page_id, text, n_lines, n_items, n_tables."""
    out = "page_id long, text string, n_lines long, n_items long, n_tables long"

    def run(batches):
        for batch in batches:
            yield batch_of([(page_id, *render(page.as_py())) for page_id, page in zip(batch.column(0).to_pylist(), batch.column(1))], out)

    return pages.select(F.col(id_col).cast("long"), F.col(html_col)).mapInArrow(run, out)
