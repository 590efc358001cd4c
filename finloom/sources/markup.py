"""Pages as events, and what is read from them in one pass: elements by CSS
selectors, cells of tables.

Pages come as rows and are parsed in Arrow batches, with nothing kept between
them.  Null and malformed pages are read as far as they go; text is what the
elements hold, entities replaced.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements without content, elements whose content is not markup,
# and elements whose start ends others: what it ends, and what it can't reach across.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "noframes", "xmp"))
_CELLS, _GROUPS = frozenset(("td", "th")), frozenset(("thead", "tbody", "tfoot"))
_OUTER = frozenset(("td", "th", "table", "caption", "button", "object", "body", "html"))
_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
_ENDS = {
    "li": (frozenset(("li",)), _OUTER | {"ul", "ol", "menu"}),
    "dt": (frozenset(("dt", "dd")), _OUTER | {"dl"}),
    "dd": (frozenset(("dt", "dd")), _OUTER | {"dl"}),
    "option": (frozenset(("option",)), _OUTER | {"select", "optgroup"}),
    "td": (_CELLS, frozenset(("tr", "table"))),
    "th": (_CELLS, frozenset(("tr", "table"))),
    "tr": (_CELLS | {"tr"}, frozenset(("table",)) | _GROUPS),
    **{g: (_GROUPS | {"tr"}, frozenset(("table",))) for g in _GROUPS},
    **{t: (frozenset(("p",)), _OUTER) for t in _ENDS_P},
}
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*>
    |<(?P<start>[a-zA-Z][^\s/>]*+)(?P<rest>(?>[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)|[^>]*)>""",
    re.VERBOSE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in RAW}

#: What an end tag can't reach across.
_HIDDEN, _NO_END = _CELLS | {"table"}, (frozenset(), frozenset())
_ENDED_BY = {t: (frozenset((t,)), frozenset(("table",))) for t in _CELLS | {"tr", "table"} | _GROUPS}
#: Characters of the tags that are remembered (8,192 of them).
SHORT_TAG = 32

START, END, TEXT = 0, 1, 2


def attributes(rest: str) -> dict[str, str]:
    """Names in lower case; the first of a repeated name wins."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), unescape(next(filter(None, values), "")))
    return found


@lru_cache(8192)
def _short_tag(token: str) -> tuple[bool, str, dict[str, str]] | None:
    """What a short tag says: whether it starts an element, its name and attributes;
    nothing for comments.  Pages repeat theirs, so each is taken apart once."""
    found = _TOKEN.match(token)
    if start := found["start"]:
        return True, start.lower(), attributes(found["rest"]) if found["rest"] else {}
    return (False, found["end"].lower(), {}) if found["end"] else None


def events(html: str, only: frozenset[str] | None = None) -> Iterator[tuple[int, str, dict[str, str] | None]]:
    """START (tag, attributes), END (tag) and TEXT (text) in order; starts and ends of
    ``only`` some tags if they are given.

    Every start has its end: those that markup leaves out are put where the next
    element ends them, ends without a start are left out.  Attributes are shared
    between elements: not to be changed.
    """
    open_tags: list[str] = []
    n_open: defaultdict[str, int] = defaultdict(int)
    at, n = 0, len(html)
    last = html.rfind(">") + 1  # no tag ends beyond
    search = _TOKEN.search

    while at < n:
        token = search(html, at, last) if at < last else None
        upto = token.start() if token else n
        if upto > at:
            text = html[at:upto]
            yield TEXT, unescape(text) if "&" in text else text, None
        if not token:
            break
        at = token.end()
        if at - upto <= SHORT_TAG:
            tag = _short_tag(html[upto:at])
        elif token["start"]:
            tag = True, token["start"].lower(), attributes(token["rest"]) if token["rest"] else {}
        else:
            tag = (False, token["end"].lower(), {}) if token["end"] else None
        if tag is None:
            continue
        starts, name, attrs = tag
        if starts:
            wanted, barrier = _ENDS.get(name, _NO_END)
        elif n_open[name]:
            wanted, barrier = _ENDED_BY[name] if name in _ENDED_BY else (frozenset((name,)), _HIDDEN)
        else:
            continue
        # The outermost open element of those wanted that no barrier hides, of one the innermost.
        depth = None
        for t in wanted:
            if n_open[t]:
                single = len(wanted) == 1
                for place in range(len(open_tags) - 1, -1, -1):
                    if open_tags[place] in wanted:
                        depth = place
                        if single:
                            break
                    elif open_tags[place] in barrier:
                        break
                break
        if depth is not None:
            while len(open_tags) > depth:
                ended = open_tags.pop()
                n_open[ended] -= 1
                if only is None or ended in only:
                    yield END, ended, None
        if starts:
            told = only is None or name in only
            if told:
                yield START, name, attrs
            if name in VOID:
                if told:
                    yield END, name, None
                continue
            if name in RAW:
                end = _RAW_END[name].search(html, at)
                upto = end.start() if end else n
                if upto > at:
                    yield TEXT, html[at:upto] if name in ("script", "style") else unescape(html[at:upto]), None
                at = upto
            n_open[name] += 1
            open_tags.append(name)
    for ended in reversed(open_tags):
        if only is None or ended in only:
            yield END, ended, None


# Selectors


@dataclass(frozen=True)
class Compound:
    """What one element must be: tag (empty: any), classes, attributes (name,
    operator, value) and its place among siblings (0: any)."""

    tag: str = ""
    classes: tuple[str, ...] = ()
    attrs: tuple[tuple[str, str, str], ...] = ()
    of_type: int = 0
    child: int = 0
    scope: bool = False

    def fits(self, tag: str, attrs: dict[str, str], of_type: int, child: int, scope: bool) -> bool:
        if (self.tag and self.tag != tag) or (self.scope and not scope) or (self.of_type not in (0, of_type)) or (self.child not in (0, child)):
            return False
        if self.classes and not set(self.classes) <= set(attrs.get("class", "").split()):
            return False
        return all(name in attrs and _TESTS[op](attrs[name], value) for name, op, value in self.attrs)


_TESTS = {
    "": lambda have, value: True,
    "=": lambda have, value: have == value,
    "^=": lambda have, value: value != "" and have.startswith(value),
    "$=": lambda have, value: value != "" and have.endswith(value),
    "*=": lambda have, value: value != "" and value in have,
    "~=": lambda have, value: value in have.split(),
}
_PART = re.compile(
    r"""(?P<comma>\s*,\s*)|(?P<child>\s*>\s*)|(?P<gap>\s+)|(?P<tag>\*|[a-zA-Z][\w-]*)|\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)
    |\[\s*(?P<name>[\w:-]+)\s*(?:(?P<op>[~^$*]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<bare>[^\]\s]+))\s*)?\]
    |:nth-of-type\((?P<of>\d+)\)|:nth-child\((?P<nth>\d+)\)|(?P<first>:first-child)|(?P<scope>:scope)""",
    re.VERBOSE,
)


def compiled(css: str) -> list[list[tuple[bool, Compound]]]:
    """Alternatives of a selector, each a path of (child of the one before, compound).

    Knows tags, ``*``, classes, ids, attributes (presence, =, ^=, $=, *=, ~=),
    :nth-of-type(n), :nth-child(n), :first-child, :scope, descendants and ``>``.
    """
    paths: list[list[tuple[bool, dict]]] = [[(False, {})]]
    at, text = 0, css.strip()
    while at < len(text):
        part = _PART.match(text, at)
        if not part:
            raise ValueError(f"selector {css!r} at {text[at:]!r}")
        at, kind, own = part.end(), part.lastgroup, paths[-1][-1][1]
        if kind == "comma":
            paths.append([(False, {})])
        elif kind == "child":
            if not own and len(paths[-1]) == 1:
                own["scope"] = True
            paths[-1].append((True, {}))
        elif kind == "gap":
            paths[-1].append((False, {}))
        elif part["name"]:
            value = next((v for v in (part["dq"], part["sq"], part["bare"]) if v is not None), "")
            own.setdefault("attrs", []).append((part["name"].lower(), part["op"] or "", value))
        elif kind == "tag":
            own["tag"] = part["tag"].lower().strip("*")
            own["any"] = True
        elif kind == "cls":
            own.setdefault("classes", []).append(part["cls"])
        elif kind == "id":
            own.setdefault("attrs", []).append(("id", "=", part["id"]))
        elif kind in ("of", "nth"):
            own["of_type" if kind == "of" else "child"] = int(part[kind])
        elif kind == "first":
            own["child"] = 1
        else:
            own["scope"] = True
    if any(not own for path in paths for _, own in path):
        raise ValueError(f"selector {css!r} has an empty part")
    freeze = {"tag": str, "classes": tuple, "attrs": tuple, "of_type": int, "child": int, "scope": bool}
    return [[(child, Compound(**{k: freeze[k](v) for k, v in own.items() if k in freeze})) for child, own in path] for path in paths]


class Machine:
    """All selectors of a scope as one automaton over the open elements.

    A bit says that the path up to a compound is matched by elements above; bits
    that hold for all below and bits for children alone travel down the stack.
    """

    def __init__(self, selectors: list[str]):
        self.compounds: list[Compound] = []
        self.then: list[tuple[bool, int] | int] = []
        self.start = 0
        self.by_tag: dict[str, int] = {"": 0}
        for owner, css in enumerate(selectors):
            for path in compiled(css):
                for i, (_, compound) in enumerate(path):
                    bit = len(self.compounds)
                    if i == 0:
                        self.start |= 1 << bit
                    self.compounds.append(compound)
                    self.then.append((path[i + 1][0], 1 << (bit + 1)) if i + 1 < len(path) else owner)
                    self.by_tag[compound.tag] = self.by_tag.get(compound.tag, 0) | 1 << bit

    def step(self, below: int, children: int, element: tuple, scope: bool = False) -> tuple[set[int], int, int]:
        """Selectors that the element matches, and the bits for what is in it."""
        left = (below | children) & (self.by_tag[""] | self.by_tag.get(element[0], 0))
        found: set[int] = set()
        inner = 0
        while left:
            bit = left & -left
            left ^= bit
            number = bit.bit_length() - 1
            if self.compounds[number].fits(*element, scope):
                after = self.then[number]
                if isinstance(after, int):
                    found.add(after)
                elif after[0]:
                    inner |= after[1]
                else:
                    below |= after[1]
        return found, below, inner


@dataclass(frozen=True)
class Field:
    """What is taken from a row: the elements in it (or itself) that ``css`` selects.

    ``take``: ``text`` (all text in the element), ``nodes`` (every text directly in
    it) or ``@name`` (an attribute; empty if the element lacks it).
    ``within``: the field whose first element is searched instead of the row.
    ``matching``: a pattern that the attribute must contain.  ``outside``: a tag;
    elements in one are passed over.  The first element only, unless ``every``.
    """

    css: str
    take: str = "text"
    within: str | None = None
    matching: str | None = None
    outside: str | None = None
    every: bool = False


class Extraction:
    """Rows (elements that a selector selects) of pages with their fields."""

    def __init__(self, rows: str, fields: dict[str, Field]):
        self.names = list(fields)
        self.fields = list(fields.values())
        self.rows = Machine([rows])
        scopes: dict[int, list[int]] = {}
        for number, field in enumerate(self.fields):
            scopes.setdefault(self.names.index(field.within) if field.within else -1, []).append(number)
        self.members = scopes
        self.machines = {scope: Machine([self.fields[i].css for i in members]) for scope, members in scopes.items()}
        self.patterns = [re.compile(f.matching) if f.matching else None for f in self.fields]

    def read(self, html: str) -> list[list[list[str]]]:
        """Of every row, in order of their starts: the values of every field."""
        rows: list[list[list[tuple[int, str]]]] = []
        texts: list[str] = []
        # An open element: tag, counts of its children by tag, active machines
        # (scope, row, bits below, bits of children), what takes its texts.
        stack: list[tuple[str, dict[str, int], list, list]] = [("", {}, [(None, None, self.rows.start, 0)], [])]
        for kind, value, attrs in events(html):
            if kind == TEXT:
                texts.append(value)
                for take in stack[-1][3]:
                    if take[0] == "nodes":
                        take[1].append((len(texts), value))
                continue
            if kind == END:
                for take in stack.pop()[3]:
                    if take[0] == "text":
                        take[1].append((take[2], "".join(texts[take[2] :])))
                continue
            _, counts, active, _ = stack[-1]
            counts[value] = counts.get(value, 0) + 1
            counts[""] = counts.get("", 0) + 1
            element = (value, attrs, counts[value], counts[""])
            inner, takes = [], []
            for scope, row, below, children in active:
                machine = self.rows if scope is None else self.machines[scope]
                found, below, own = machine.step(below, children, element)
                inner.append((scope, row, below, own))
                self._matched(scope, row, found, element, rows, texts, stack, inner, takes)
            stack.append((value, {}, inner, takes))
        return [[[text for _, text in sorted(values, key=lambda x: x[0])] for values in row] for row in rows]

    def _matched(self, scope, row, found, element, rows, texts, stack, inner, takes) -> None:
        if scope is None:
            if found:
                rows.append([[] for _ in self.fields])
                self._enter(-1, (len(rows) - 1, set()), element, rows, texts, stack, inner, takes)
            return
        number, taken = row
        for i in sorted(found):
            field = self.members[scope][i]
            self._take(field, number, taken, element, rows, texts, stack, inner, takes)

    def _enter(self, scope, row, element, rows, texts, stack, inner, takes) -> None:
        """Start the machine of a scope at an element, which may match itself."""
        if scope in self.machines:
            machine = self.machines[scope]
            found, below, own = machine.step(machine.start, 0, element, True)
            inner.append((scope, row, below, own))
            self._matched(scope, row, found, element, rows, texts, stack, inner, takes)

    def _take(self, number, row, taken, element, rows, texts, stack, inner, takes) -> None:
        field = self.fields[number]
        if (number in taken and not field.every) or (field.outside and any(x[0] == field.outside for x in stack)):
            return
        values = rows[row][number]
        if field.take[0] == "@":
            value = element[1].get(field.take[1:], "")
            if self.patterns[number] and not self.patterns[number].search(value):
                return
            values.append((len(texts), value))
        elif field.take == "nodes":
            takes.append(("nodes", values))
        else:
            takes.append(("text", values, len(texts)))
        first = number not in taken
        taken.add(number)
        if first:
            self._enter(number, (row, taken), element, rows, texts, stack, inner, takes)


def select_rows(pages: DataFrame, key: str, html: str, rows: str, fields: dict[str, Field], keep: tuple[str, ...] = ()) -> DataFrame:
    """key, the columns ``keep``, row (from 0, by page) and the fields (arrays of
    strings, empty where nothing matches) of every element that ``rows`` selects.

    Every page is parsed once, whatever the number of selectors; no shuffle.
    """
    names = [key, *keep]
    picked = pages.select(*names, F.col(html).cast("string").alias("html"))
    found = T.ArrayType(T.StringType())
    schema = T.StructType([*(picked.schema[c] for c in names), T.StructField("row", T.IntegerType()), *(T.StructField(f, found) for f in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extraction = Extraction(rows, fields)
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                each = [extraction.read(x or "") for x in part.column(part.num_columns - 1).to_pylist()]
                page = pa.array([i for i, x in enumerate(each) for _ in x], pa.int32())
                place = pa.array([j for x in each for j in range(len(x))], pa.int32())
                values = [pa.array([r[f] for x in each for r in x], pa.list_(pa.string())) for f in range(len(fields))]
                kept = [part.column(i).take(page) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*kept, place, *values], [f.name for f in schema])

    return picked.mapInArrow(run, schema)


# Tables

MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534  # fixed values of the HTML standard
_TABLE_TAGS = _CELLS | _GROUPS | {"table", "tr"}
_NUMBER = re.compile(r"\s*\+?(\d+)")


def span(text: str | None, most: int) -> int:
    """A span as browsers read it: 1 unless it is a number; 0 (rows: to the end of the group) stays."""
    digits = _NUMBER.match(text) if text else None
    return min(int(digits[1]), most) if digits else 1


def table_cells(html: str) -> list[tuple[int, int, int, str, int, int, bool, str]]:
    """Table, row, column, value, rowspan, colspan, header and label of every cell,
    by the start of its table, then in order.

    A cell takes the first free columns of its row; rowspans keep columns of
    later rows of their group.  Spans are as they apply: cut at the end of the
    group.  Rows of headers alone at the top (or in thead) label the columns;
    a cell's label joins the headers above its first column.  A table in a cell
    is a table of its own, whose text the cell holds too.
    """
    out: list[list] = []
    tables: list[dict] = []
    texts: list[str] = []
    n_tables = 0

    def end_group(t: dict) -> None:
        for cell in t["reaching"]:
            cell[4] = min(cell[4], t["row"] + 1 - cell[1]) if cell[4] else t["row"] + 1 - cell[1]
        t["reaching"], t["until"] = [], {}

    def end_cell(t: dict) -> None:
        if (cell := t["cell"]) is not None:
            cell[3] = " ".join("".join(texts[cell[3] :]).split())
            t["cell"] = None

    for kind, value, attrs in events(html, _TABLE_TAGS):
        if kind == TEXT:
            if tables:
                texts.append(value)
            continue
        t = tables[-1] if tables else None
        if kind == START:
            if value == "table":
                tables.append({"number": n_tables, "row": -1, "until": {}, "reaching": [], "cell": None, "labels": {}, "joined": {}, "head": False, "body": False, "cells": []})
                n_tables += 1
            elif t is None:
                continue
            elif value in _CELLS:
                if t["row"] < 0:
                    t["row"], t["col"], t["line"] = 0, 0, []
                row, col, until, rows, cols = t["row"], t["col"], t["until"], 1, 1
                while until and until.get(col, -1) >= row:
                    col += 1
                if attrs:
                    rows, cols = span(attrs.get("rowspan"), MAX_ROWSPAN), span(attrs.get("colspan"), MAX_COLSPAN) or 1
                end_cell(t)  # one that a group in it keeps open
                t["cell"] = cell = [t["number"], row, col, len(texts), rows, cols, value == "th", ""]
                t["col"] = col + cols
                if rows != 1:
                    # Only these reach a row that comes later.
                    last = row + rows - 1 if rows else row + MAX_ROWSPAN
                    for c in range(col, col + cols):
                        until[c] = max(last, until.get(c, -1))
                    t["reaching"].append(cell)
                t["line"].append(cell)
                t["cells"].append(cell)
            elif value == "tr":
                t["row"] += 1
                t["col"], t["line"] = 0, []
            else:
                end_group(t)
                t["head"] = value == "thead"
        elif t is not None:
            if value in _CELLS:
                end_cell(t)
            elif value == "tr":
                if t["row"] >= 0 and t.get("line"):
                    _end_row(t)
            elif value == "table":
                if t.get("line"):
                    _end_row(t)
                end_group(t)
                out.append(tables.pop()["cells"])
            else:
                end_group(t)
                t["head"] = False
    return [c for cells in sorted((x for x in out if x), key=lambda x: x[0][0]) for c in map(tuple, cells)]


def _end_row(t: dict) -> None:
    """Label the cells of a row, or take its headers as labels."""
    line, t["line"] = t["line"], []
    if t["head"] or (not t["body"] and all(c[6] for c in line)):
        t["joined"] = {}
        for cell in line:
            for c in range(cell[2], cell[2] + cell[5]):
                t["labels"].setdefault(c, []).append(cell[3])
        return
    t["body"], joined = True, t["joined"]
    for cell in line:
        label = joined.get(cell[2])
        if label is None:
            label = joined[cell[2]] = " / ".join(filter(None, t["labels"].get(cell[2], ())))
        cell[7] = label


_CELL_TYPES = (("table", "int"), ("row", "int"), ("col", "int"), ("value", "string"), ("rowspan", "int"), ("colspan", "int"), ("header", "boolean"), ("label", "string"))


def page_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key and the cells of all tables of pages: table (from 0), row, col, value
    (white space as one space), rowspan, colspan, header, label.  See ``table_cells``."""
    picked = pages.select(key, F.col(html).cast("string").alias("html"))
    arrow = {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                each = [table_cells(x or "") for x in part.column(1).to_pylist()]
                owner = pa.array([i for i, x in enumerate(each) for _ in x], pa.int32())
                values = list(zip(*(c for x in each for c in x))) or [()] * len(_CELL_TYPES)
                columns = [pa.array(v, arrow[kind]) for v, (_, kind) in zip(values, _CELL_TYPES)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(owner), *columns], [key, *(n for n, _ in _CELL_TYPES)])

    schema = T.StructType([picked.schema[key], *(T.StructField(n, {"int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType()}[k]) for n, k in _CELL_TYPES)])
    return picked.mapInArrow(run, schema)


def converted_cells(cells: str) -> F.Column:
    """SQL column ``cells`` (array of struct row, col, text, rowspan, colspan, of any
    types) as typed cells: those whose row or column is no number are dropped, null
    text is empty, spans that are missing or 0 are 1; never empty: one blank cell."""
    number = "try_cast(c.{0} AS INT)"
    whole = f"""filter(transform({cells}, c -> named_struct('row', {number.format('row')}, 'col', {number.format('col')},
        'value', coalesce(CAST(c.text AS STRING), ''), 'rowspan', coalesce(nullif({number.format('rowspan')}, 0), 1),
        'colspan', coalesce(nullif({number.format('colspan')}, 0), 1))), c -> c.row IS NOT NULL AND c.col IS NOT NULL)"""
    blank = "array(named_struct('row', 0, 'col', 0, 'value', '', 'rowspan', 1, 'colspan', 1))"
    return F.expr(f"coalesce(nullif({whole}, array()), {blank})")
