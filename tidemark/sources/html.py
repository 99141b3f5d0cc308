"""HTML payloads as rows of elements: one pass over a page builds its tree and finds the elements that named selectors want.

The parser runs in mapInArrow, a batch of pages at a time; everything after it
(which links, numbers, dates, locks, duplicates) is column expressions. An
element is an interval: its descendants are the elements with pos < x < end, and
its text is a slice of the page's text. Pages are read as browsers read them:
tags that may be left out are implied, and nothing makes the parser fail. Its
work grows with the length of a page, however its elements nest; only texts of
wanted elements are copied.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship

#: Fixed values, from the HTML standard: which elements have no end tag, close an open paragraph, and bound the search for an open element.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt listing main menu nav ol p plaintext pre search section summary table ul xmp".split()
)
SCOPE = frozenset("applet caption html table td th marquee object template".split())
P_SCOPE = SCOPE | {"button"}
SPECIAL = frozenset(
    "applet area article aside base basefont bgsound blockquote body br button caption center col colgroup dd details dir dl dt embed fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "iframe img input keygen li link listing main marquee menu meta nav noembed noframes noscript object ol param plaintext pre script search section select source style summary table tbody td template textarea tfoot th thead title tr track ul wbr xmp".split()
)
TABLE_PARTS = {"tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")} | {t: ("tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup") for t in ("tbody", "thead", "tfoot")}
IN_TABLE = frozenset("table tbody thead tfoot tr td th caption colgroup".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
FOREIGN = ("svg", "math")
ONCE = ("html", "body")
#: Elements whose start ends an open one of their own, and those whose start may end others.
ALONE = ("a", "button")
IMPLIES = CLOSES_P | TABLE_PARTS.keys() | set(HEADINGS) | {"li", "dt", "dd", "option", "optgroup"}
ELEMENTS = "page_id long, pos int, end int, parent int, depth int, tag string, id string, class string, attrs map<string,string>, marks array<string>, text string, up int"

_SIMPLE = re.compile(r"(?P<tag>\*|[A-Za-z][\w-]*)|#(?P<id>[\w-]+)|\.(?P<cls>(?:[\w-]|\\.)+)|\[(?P<attr>[\w-]+)(?:(?P<op>[*^$~]?=)(?P<q>['\"])(?P<value>.*?)(?P=q))?\]")

_WHITE = " \t\n\r\f"
_NAME = re.compile(r"[^\s/>]+")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:(?P<q>['\"])|([^\s>]*)))?")
_TAG_END = re.compile(r"[\s/]*>")
#: A text and the tag after it, as most are written: attributes only in double quotes. What it doesn't match is read step by step.
_PLAIN = re.compile(r'([^<]*)(</?[A-Za-z][^\s/>]*(?:\s+[^\s/>=]+="[^"]*")*\s*>)')
_PAIR = re.compile(r'([^\s/>=]+)="([^"]*)"')
_COMMENT_END = re.compile("--!?>")
_REFERENCE = re.compile(r"&(?:#\w+|[A-Za-z][A-Za-z0-9]*);?")
#: Fixed values, from the HTML standard: elements whose content is text up to their end tag, and those of them in which references count.
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in ("script", "style", "xmp", "iframe", "noembed", "noframes", "textarea", "title")}
DECODED = frozenset(("textarea", "title"))


def _value(raw: str) -> str:
    """An attribute's value: a name without its semicolon isn't a reference where it goes on, as in ?a=1&copy=2."""

    def one(m):
        name = m[0]
        if not name.endswith(";") and name[1] != "#" and (name[1:] not in html5 or raw[m.end() : m.end() + 1] == "="):
            return name
        return unescape(name)

    return _REFERENCE.sub(one, raw) if "&" in raw else raw


@lru_cache(maxsize=256)
def _compiled(selector: str) -> list[list[tuple[str, str | None, str | None, tuple, tuple]]]:
    """Alternatives of steps (combinator, tag, id, classes, attributes) of `a.b #c > d[e*='f'], g`."""
    out = []
    for group in re.split(r",(?![^\[]*\])", selector):
        steps, combinator = [], " "
        for part in re.findall(r"(?:\[[^\]]*\]|[^\s>\[])+|>|\[", group):
            if part == ">":
                combinator = ">"
                continue
            tag = ident = None
            classes, attrs, at = [], [], 0
            while at < len(part):
                m = _SIMPLE.match(part, at)
                if m is None:
                    raise ValueError(f"not a selector: {selector}")
                at = m.end()
                if m["tag"]:
                    tag = None if m["tag"] == "*" else m["tag"].lower()
                elif m["id"]:
                    ident = m["id"]
                elif m["cls"]:
                    classes.append(m["cls"].replace("\\", ""))
                else:
                    attrs.append((m["attr"].lower(), m["op"], m["value"]))
            steps.append((combinator, tag, ident, tuple(classes), tuple(attrs)))
            combinator = " "
        if not steps or combinator == ">":
            raise ValueError(f"not a selector: {selector}")
        out.append(steps)
    return out


def _holds(value: str | None, op: str | None, wanted: str | None) -> bool:
    if value is None:
        return False
    if op is None:
        return True
    return {"=": value == wanted, "*=": wanted in value, "^=": value.startswith(wanted), "$=": value.endswith(wanted), "~=": wanted in value.split()}[op]


class Plan:
    """Of named selectors: every simple one once, with the steps that it stands for; and what was found out about tags that pages repeat, word by word."""

    #: So many tags of so many characters are remembered at most.
    MOST, LONGEST = 1 << 13, 300

    def __init__(self, marks: tuple[tuple[str, str], ...]):
        self.simple: dict[tuple, list[tuple]] = {}  # (tag, id, classes, attrs) -> (bit, bit of the step before or 0, whether that is the parent's, name if it is the last)
        bit = 1
        for name, selector in marks:
            for group in _compiled(selector):
                for k, (combinator, *simple) in enumerate(group):
                    self.simple.setdefault(tuple(simple), []).append((bit, bit >> 1 if k else 0, combinator == ">", name if k == len(group) - 1 else None))
                    bit <<= 1
        self.tags: dict[str, tuple] = {}

    def steps(self, tag: str, attrs: dict[str, str]) -> tuple[tuple, ...]:
        """The steps whose simple selector the element meets, in their order."""
        out, classes = [], None
        for (want, ident, cls, conditions), steps in self.simple.items():
            if (want is not None and want != tag) or (ident is not None and attrs.get("id") != ident):
                continue
            if cls:
                classes = attrs.get("class", "").split() if classes is None else classes
                if not all(c in classes for c in cls):
                    continue
            if all(_holds(attrs.get(a), op, value) for a, op, value in conditions):
                out += steps
        return tuple(sorted(out, key=lambda step: step[0]))

    def tag(self, plain: str) -> tuple[bool, str, dict[str, str], tuple]:
        """Of a tag that _PLAIN matches: whether it closes, its name, attributes and steps."""
        closing = plain[1] == "/"
        name = _NAME.match(plain, 1 + closing)
        tag, attrs = name[0].lower(), {}
        for attr, value in _PAIR.findall(plain, name.end()):
            attrs.setdefault(attr.lower(), _value(value))
        found = (closing, tag, attrs, () if closing else self.steps(tag, attrs))
        if len(plain) <= self.LONGEST:
            if len(self.tags) >= self.MOST:
                self.tags.clear()
            self.tags[plain] = found
        return found


@lru_cache(maxsize=16)
def _plan(marks: tuple[tuple[str, str], ...]) -> Plan:
    return Plan(marks)


class Tree:
    """Wanted elements in document order, from one walk over the page that never goes back.

    marks: name -> selector; an element that meets one is wanted. Without
    marks, all are, or those of the tags. texts: the marks whose elements' texts
    are wanted, if not all. up: a mark; each element gets the place of its
    nearest ancestor with it. written: texts keep their references as the page
    writes them. What is known of the open elements (nearest list
    item, paragraph, scope, matched steps) is carried down from parent to child,
    so no tag looks through the stack.
    """

    def __init__(self, marks: dict[str, str] | None = None, tags: frozenset[str] | None = None, texts: tuple[str, ...] | None = None, up: str | None = None, written: bool = False):
        self.tags, self.all, self.texts, self.up = tags, marks is None and tags is None, None if texts is None else frozenset(texts), up
        self.written = written
        self.plan = _plan(tuple((marks or {}).items()))
        self.nodes: list[list] = []
        self.parts: list[str] = []
        self.length = self.count = self.foreign = 0
        self.stack: list[tuple] = []
        self.places: dict[str, list[int]] = defaultdict(list)  # of each tag, where it stands in the stack
        self.met: set[str] = set()

    # (tag, node, pos, li, dd, p, scope, table, matched here, matched here or above, nearest for what is inside)
    TOP = ("", None, -1, -1, -1, -1, -1, -1, 0, 0, -1)

    def _close(self, at: int) -> None:
        stack, places = self.stack, self.places
        while len(stack) > at:
            top = stack.pop()
            tag, node = top[0], top[1]
            places[tag].pop()
            if tag in FOREIGN:
                self.foreign -= 1
            if node is not None:
                node[1], node[10] = self.count, self.length

    def _nearest(self, tags: tuple[str, ...], limit: int) -> int:
        """The outermost of the innermost open elements of the tags, not outside the limit; -1 without any."""
        found = [self.places[t][-1] for t in tags if self.places[t] and self.places[t][-1] >= limit]
        return min(found, default=-1)

    def _imply(self, tag: str) -> None:
        """Ends what this start tag ends."""
        top = self.stack[-1] if self.stack else self.TOP
        if self.places["head"] and (tag == "body" or (top[0] == "head" and tag not in HEAD)):
            self._close(self.places["head"][-1])
            top = self.stack[-1] if self.stack else self.TOP
        if tag in CLOSES_P and top[5] >= 0:
            self._close(top[5])
            top = self.stack[-1] if self.stack else self.TOP
        at = -1
        if tag == "li":
            at = top[3]
        elif tag in ("dt", "dd"):
            at = top[4]
        elif tag in ("option", "optgroup"):
            if top[0] == "option":
                at = len(self.stack) - 1
                if tag == "optgroup" and at and self.stack[at - 1][0] == "optgroup":
                    at -= 1
            elif tag == top[0] == "optgroup":
                at = len(self.stack) - 1
        elif tag in TABLE_PARTS:
            at = self._nearest(TABLE_PARTS[tag], top[7] + 1)
        elif tag in ALONE:
            found = self.places[tag]
            at = found[-1] if found and found[-1] > top[6] else -1
        elif tag in HEADINGS and top[0] in HEADINGS:
            at = len(self.stack) - 1
        if at >= 0:
            self._close(at)

    def start(self, tag: str, attrs: dict[str, str], closed: bool, steps: tuple[tuple, ...]) -> None:
        if tag in ONCE:
            if tag in self.met:
                return
            self.met.add(tag)
        stack, places = self.stack, self.places
        if (tag in IMPLIES or (tag in ALONE and places[tag]) or places["head"]) and not self.foreign and stack:
            self._imply(tag)
        _, _, parent, li, dd, p, scope, table, here, above, near = stack[-1] if stack else self.TOP
        bits, names = 0, []
        for bit, before, child, name in steps:
            if before and not before & (here if child else above):
                continue
            bits |= bit
            if name is not None and name not in names:
                names.append(name)
        node, pos, i = None, self.count, len(stack)
        if names or self.all or (self.tags is not None and tag in self.tags):
            node = [pos, pos + 1, parent, i, tag, attrs, names, "", near, self.length, self.length]
            self.nodes.append(node)
        self.count = pos + 1
        if tag in VOID:
            return
        if tag == "p":
            p = i
        elif tag in SPECIAL:
            li, dd = i if tag == "li" else -1, i if tag in ("dt", "dd") else -1
        if tag in P_SCOPE:
            p = -1
            if tag in SCOPE:
                scope = i
                if tag == "table" or tag == "template":
                    table = i
        stack.append((tag, node, pos, li, dd, p, scope, table, bits, bits | above, pos if names and self.up in names else near))
        places[tag].append(i)
        if tag in FOREIGN:
            self.foreign += 1
        if closed and self.foreign:
            self._close(i)

    def end(self, tag: str) -> None:
        if not self.stack or tag in ONCE or tag in VOID:
            return
        top = self.stack[-1]
        limit = top[7] if tag in IN_TABLE else top[6]
        if tag in HEADINGS:
            at = max((self.places[t][-1] for t in HEADINGS if self.places[t] and self.places[t][-1] >= limit), default=-1)
        else:
            at = self._nearest((tag,), limit)
        if at >= 0:
            self._close(at)

    def data(self, text: str, decode: bool = True) -> None:
        if text:
            if decode and not self.written:
                text = unescape(text)
            self.parts.append(text)
            self.length += len(text)

    def _tag(self, html: str, i: int) -> tuple[dict[str, str], bool, int] | None:
        """Attributes, whether it closes itself, and the end of a tag whose name ends at i; None if the page ends first."""
        attrs: dict[str, str] = {}
        while True:
            if end := _TAG_END.match(html, i):
                return attrs, html[end.end() - 2] == "/", end.end()
            m = _ATTRIBUTE.match(html, i)
            if m is None:
                return None
            i, value = m.end(), m[3]
            if m["q"]:
                close = html.find(m["q"], i)
                if close < 0:
                    return None
                value, i = html[i:close], close + 1
            attrs.setdefault(m[1].lower(), _value(value or ""))

    def read(self, html: str) -> list[list]:
        """Nodes (pos, end, parent, depth, tag, attrs, marks, text, up, ...)."""
        i, n, plan = 0, len(html), self.plan
        plain, known, stack, places = _PLAIN.match, plan.tags, self.stack, self.places
        while i < n:
            if m := plain(html, i):
                i, closed = m.end(), False
                text, written = m.groups()
                if text:
                    self.data(text)
                closing, tag, attrs, steps = known.get(written) or plan.tag(written)
            else:
                at = html.find("<", i)
                if at < 0 or at == n - 1:
                    self.data(html[i:])
                    break
                after = html[at + 1]
                if not (after.isascii() and after.isalpha()) and after not in "/!?":
                    self.data(html[i : at + 1])
                    i = at + 1
                    continue
                self.data(html[i:at])
                closing = after == "/"
                begin = at + 1 + closing
                if not (html[begin : begin + 1].isascii() and html[begin : begin + 1].isalpha()):
                    i = self._declared(html, at)
                    continue
                name = _NAME.match(html, begin)
                found = self._tag(html, name.end())
                if found is None:  # the page ends inside the tag
                    break
                attrs, closed, i = found
                tag = name[0].lower()
                steps = () if closing else plan.steps(tag, attrs)
            if closing:
                if stack and stack[-1][0] == tag and tag not in ONCE:
                    node = stack.pop()[1]
                    places[tag].pop()
                    if tag in FOREIGN:
                        self.foreign -= 1
                    if node is not None:
                        node[1], node[10] = self.count, self.length
                else:
                    self.end(tag)
                continue
            self.start(tag, attrs, closed, steps)
            if tag in RAW and not self.foreign:
                stop = RAW[tag].search(html, i)
                text = html[i : stop.start() if stop else n]
                self.data(text, tag in DECODED)
                i += len(text)
        self._close(0)
        text = "".join(self.parts)
        for node in self.nodes:
            if self.texts is None or not self.texts.isdisjoint(node[6]):
                node[7] = text[node[9] : node[10]]
        return self.nodes

    def _declared(self, html: str, at: int) -> int:
        """The end of a comment, a declaration or what counts as one; without an end it takes the rest of the page."""
        if html.startswith("<!--", at):
            if short := re.match("-?>", html[at + 4 : at + 6]):
                return at + 4 + short.end()
            end = _COMMENT_END.search(html, at + 4)
            return end.end() if end else len(html)
        if self.foreign and html.startswith("<![CDATA[", at):
            end = html.find("]]>", at)
            self.data(html[at + 9 : end if end >= 0 else len(html)], False)
            return end + 3 if end >= 0 else len(html)
        end = html.find(">", at)
        return end + 1 if end >= 0 else len(html)


def parse(html: str | None, marks: dict[str, str] | None = None, tags: frozenset[str] | None = None, texts: tuple[str, ...] | None = None, up: str | None = None, written: bool = False) -> list[list]:
    """(pos, end, parent, depth, tag, attrs, marks, text, up, ...) of each wanted element."""
    return Tree(marks, tags, texts, up, written).read(html or "")


def elements(pages: DataFrame, tags: tuple[str, ...] | None = None, marks: dict[str, str] | None = None, texts: tuple[str, ...] | None = None, up: str | None = None) -> DataFrame:
    """Elements of pages (page_id, html): those that a selector in marks wants, with the names of all that do; or those of the tags; or all. A null html has none. texts and up: see Tree."""
    ship(pages.sparkSession)
    wanted = frozenset(tags) if tags else None

    def run(batches) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), *[pa.int32()] * 4, *[pa.string()] * 3, pa.map_(pa.string(), pa.string()), pa.list_(pa.string()), pa.string(), pa.int32()]
        names = [c.split()[0] for c in ELEMENTS.split(", ")]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            rows, size = [], 0
            for page, html in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist(), strict=True):
                for pos, end, parent, depth, tag, attrs, met, text, above, *_ in parse(html, marks, wanted, texts, up):
                    rows.append((page, pos, end, parent, depth, tag, attrs.get("id"), attrs.get("class"), list(attrs.items()), met, text, above))
                    size += len(text) + 100
                    if size > 4 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
            if rows:
                yield batch_of(rows)

    return pages.select("page_id", "html").mapInArrow(run, ELEMENTS)


def by_page(pages: DataFrame, attrs: tuple[str, ...] = (), tags: tuple[str, ...] | None = None, marks: dict[str, str] | None = None, texts: tuple[str, ...] | None = None, written: bool = False) -> DataFrame:
    """One row a page (page_id, html): page_id and e, its wanted elements in document order, each with the attributes of these names and its marks as bits, see met(). What is worked out within a page from these needs no exchange. A null html has none."""
    ship(pages.sparkSession)
    wanted, bits = frozenset(tags) if tags else None, {name: 1 << i for i, name in enumerate(marks or ())}
    kinds = ["pos int", "end int", "marks long", *[f"`{a}` string" for a in attrs], "text string"]

    def run(batches) -> Iterator:
        import pyarrow as pa

        types = [pa.int32(), pa.int32(), pa.int64(), *[pa.string()] * len(attrs), pa.string()]
        fields = [pa.field(n, t) for n, t in zip(("pos", "end", "marks", *attrs, "text"), types, strict=True)]

        def batch_of(ids, ends, rows):
            columns = [[r[0] for r in rows], [r[1] for r in rows], [sum([bits[m] for m in r[6]]) for r in rows], *[[r[5].get(a) for r in rows] for a in attrs], [r[7] for r in rows]]
            e = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], fields=fields)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), e)], names=["page_id", "e"])

        for batch in batches:
            ids, ends, rows, size = [], [0], [], 0
            for page, html in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist(), strict=True):
                nodes = parse(html, marks, wanted, texts, None, written)
                rows += nodes
                size += sum([len(n[7]) for n in nodes]) + 100 * len(nodes)
                ids.append(page)
                ends.append(len(rows))
                if size > 4 << 20:
                    yield batch_of(ids, ends, rows)
                    ids, ends, rows, size = [], [0], [], 0
            if ids:
                yield batch_of(ids, ends, rows)

    return pages.select("page_id", "html").mapInArrow(run, f"page_id long, e array<struct<{', '.join(kinds)}>>")


def met(x: Column, marks: dict[str, str], name: str) -> Column:
    """Whether the selector of that name in marks wants an element, or one of some elements whose bits are joined, of by_page()."""
    return x.bitwiseAND(F.lit(1 << list(marks).index(name)).cast("long")) != 0


def marked(name: str) -> Column:
    """Whether the selector of that name wants the element."""
    return F.array_contains("marks", name)


def has_class(column: Column, name: str) -> Column:
    return F.array_contains(F.split(F.coalesce(column, F.lit("")), r"\s+"), name)


def flatten_objects(value) -> list[dict]:
    """Every object inside a JSON value, outer ones first, in document order."""
    out, stack = [], [value]
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            out.append(v)
            stack += reversed(list(v.values()))
        elif isinstance(v, list):
            stack += reversed(v)
    return out


def unwrap(value):
    """[kind, value] tuples, as island properties are written, to plain values; a list whose first item is no number is a list."""
    if isinstance(value, list):
        if value and isinstance(value[0], (int, float)) and not isinstance(value[0], bool):
            return unwrap(value[1]) if len(value) > 1 else None
        return [unwrap(v) for v in value]
    return {k: unwrap(v) for k, v in value.items()} if isinstance(value, dict) else value


def _json_rows(frame: DataFrame, column: str, schema: str, make) -> DataFrame:
    """Rows made from a JSON column of (page_id, pos, column); JSON that can't be read makes none."""
    ship(frame.sparkSession)

    def run(frames) -> Iterator:
        import pandas as pd

        names = [c.split()[0] for c in schema.split(", ")]
        for f in frames:
            rows = []
            for page, pos, text in zip(f["page_id"], f["pos"], f[column], strict=True):
                try:
                    value = json.loads(text)
                except (TypeError, ValueError):
                    continue
                rows += [(page, pos, *r) for r in make(value)]
            yield pd.DataFrame(rows, columns=names)

    return frame.select("page_id", "pos", column).mapInPandas(run, schema)


def json_ld(scripts: DataFrame) -> DataFrame:
    """(page_id, pos, at, type, url, position, name, date_published) of each object in JSON-LD scripts; only texts and numbers count as values."""

    def text(v):
        return v if isinstance(v, str) else None

    def make(value):
        for at, o in enumerate(flatten_objects(value)):
            p = o.get("position")
            yield at, text(o.get("@type")), text(o.get("url")), str(p) if isinstance(p, (str, int, float)) and not isinstance(p, bool) else None, text(o.get("name")), text(o.get("datePublished"))

    return _json_rows(scripts, "text", "page_id long, pos int, at int, type string, url string, position string, name string, date_published string", make)


def island_chapters(islands: DataFrame) -> DataFrame:
    """(page_id, pos, number, premium, until) of each chapter in island properties that list chapters."""

    def make(value):
        v = unwrap(value)
        if not isinstance(v, dict) or not isinstance(v.get("chapters"), list):
            return
        yield None, None, None
        for c in v["chapters"]:
            if isinstance(c, dict):
                n = c.get("number")
                n = float(n) if isinstance(n, (int, float)) and not isinstance(n, bool) else None if not isinstance(n, str) else n
                yield str(n) if n is not None else None, c.get("is_premium") is True, c.get("early_access_until") if isinstance(c.get("early_access_until"), str) else None

    return _json_rows(islands, "props", "page_id long, pos int, number string, premium boolean, until string", make)


def outcomes(payloads: DataFrame, rows: DataFrame, key: str = "page_id", blank_below: int = 5000) -> DataFrame:
    """payloads (key, status, html) with outcome and blank: `error` for a bad status, none, or a page that is a challenge, else `chapters` or `empty`. No payload is lost."""
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    met = payloads.join(n, key, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    low = F.lower(F.coalesce("html", F.lit("")))
    challenge = low.rlike(r"<title>\s*just a moment") | F.contains(F.coalesce("html", F.lit("")), F.lit("cf-browser-verification"))
    bad = ~F.coalesce(F.col("status").between(200, 299), F.lit(False)) | F.coalesce(challenge, F.lit(False))
    out = met.withColumn("outcome", F.when(bad, "error").when(F.col("rows") > 0, "chapters").otherwise("empty"))
    return out.withColumn("blank", (F.col("rows") == 0) & (F.length(F.coalesce("html", F.lit(""))) < blank_below))
