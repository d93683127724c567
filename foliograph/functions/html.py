"""HTML to structured text and links, over the standard library's tolerant tokenizer.

Text comes from one pass over a flat list of tokens, links from a small tree. The kernels work on whole Arrow batches,
and get only the texts that hold a tag or a character reference.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types

from foliograph.functions import text as T

#: Elements without content, and elements that make a line of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("p div section article blockquote figcaption h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset(["ul", "ol"])
STRUCTURE = BLOCKS | LISTS | {"table"}
ROWS, CELLS, ITEMS, UNSEEN = frozenset(["tr"]), frozenset(["th", "td"]), frozenset(["li"]), frozenset(["script", "style"])

_INNER_BLANKS = re.compile("[ \t\u00a0\u200b]+")


@dataclass(slots=True)
class Node:
    name: str
    attrs: dict[str, str | None] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)

    def walk(self) -> Iterator[Node]:
        """Elements below this one in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def strings(self) -> Iterator[str]:
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            else:
                stack.extend(reversed(x.children))

    def text(self, joint: str = " ") -> str:
        """Stripped strings below, the empty ones left out, joined."""
        return joint.join(s for x in self.strings() if (s := x.strip()))

    def find_all(self, *names: str) -> list[Node]:
        return [n for n in self.walk() if n.name in names]


class _Builder(HTMLParser):
    """Unclosed elements nest; an end tag closes up to its nearest open namesake and is ignored without one."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.open[-1].children.append(Node(tag, dict(attrs)))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        into = self.open[-1].children
        if into and isinstance(into[-1], str):
            into[-1] += data
        else:
            into.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def clean_line(s: str) -> str:
    return _INNER_BLANKS.sub(" ", s).strip()


_START, _TEXT, _REMARK = range(3)


class _Tokens(HTMLParser):
    """Starts of elements, texts and remarks (comments and declarations) in document order, as flat columns.

    `last` is the index just behind what a token holds, and `up` the start token it stands in. An end tag closes up to
    its nearest open namesake and is ignored without one; what is still open ends with the document.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.sort: list[int] = []
        self.value: list[str] = []
        self.last: list[int] = []
        self.up: list[int] = []
        self._open: list[int] = []

    def _add(self, sort: int, value: str) -> None:
        self.sort.append(sort)
        self.value.append(value)
        self.last.append(len(self.sort))
        self.up.append(self._open[-1] if self._open else -1)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._add(_START, tag)
        if tag not in VOID:
            self._open.append(len(self.sort) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._add(_START, tag)

    def handle_endtag(self, tag: str) -> None:
        if any(self.value[i] == tag for i in self._open):
            self._close(lambda i: self.value[i] == tag)

    def _close(self, stop: Callable[[int], bool]) -> None:
        while self._open:
            i = self._open.pop()
            self.last[i] = len(self.sort)
            if stop(i):
                return

    def handle_data(self, data: str) -> None:
        if self.sort and self.sort[-1] == _TEXT and self.last[-1] == len(self.sort) and self.up[-1] == (self._open[-1] if self._open else -1):
            self.value[-1] += data
        else:
            self._add(_TEXT, data)

    def handle_comment(self, data: str) -> None:
        self._add(_REMARK, data)

    def handle_decl(self, decl: str) -> None:
        self._add(_REMARK, decl)

    def finish(self) -> None:
        self.close()
        self._close(lambda i: False)


#: Kinds of pieces of the text being made: a line of its own, text that runs on from the line before, a break.
_LINE, _RUN, _BREAK = range(3)


class _Scan:
    """One pass over the tokens. A running count of the starts of blocks, lists and tables tells in constant time whether
    an element holds any, and so whether it is passed over as one piece of text or entered; entering is going on with the
    next token, so that no depth of nesting needs a stack."""

    def __init__(self, html: str):
        t = _Tokens()
        t.feed(html)
        t.finish()
        self.t = t
        self.structures = [0, *accumulate(sort == _START and value in STRUCTURE for sort, value in zip(t.sort, t.value, strict=True))]

    def said(self, i: int) -> str:
        """Stripped texts inside the element i, the empty ones left out, joined by blanks."""
        out, j = [], i + 1
        while j < self.t.last[i]:
            if self.t.sort[j] == _START and self.t.value[j] in UNSEEN:
                j = self.t.last[j]
                continue
            if self.t.sort[j] == _TEXT and (s := self.t.value[j].strip()):
                out.append(s)
            j += 1
        return clean_line(" ".join(out))

    def inside(self, i: int, names: frozenset[str]) -> list[int]:
        return [j for j in range(i + 1, self.t.last[i]) if self.t.sort[j] == _START and self.t.value[j] in names]

    def rows(self, i: int) -> list[str]:
        cells = [[self.said(c) for c in self.inside(r, CELLS)] for r in self.inside(i, ROWS)]
        return [" | ".join(r) for r in cells if any(r)]

    def items(self, i: int) -> list[str]:
        own = [j for j in self.inside(i, ITEMS) if self.t.up[j] == i]
        marks = ["-"] * len(own) if self.t.value[i] == "ul" else [f"{n}." for n in range(1, len(own) + 1)]
        return [f"{mark} {self.said(j)}".strip() for mark, j in zip(marks, own, strict=True)]

    def pieces(self) -> Iterator[tuple[int, str]]:
        t, i = self.t, 0
        while i < len(t.sort):
            name, behind = t.value[i], t.last[i]
            if t.sort[i] != _START:
                yield _LINE, clean_line(name)
            elif name in UNSEEN:
                pass
            elif name == "br":
                yield _BREAK, ""
            elif name == "table" or name in LISTS or name in HEADINGS:
                lines = self.rows(i) if name == "table" else self.items(i) if name in LISTS else [self.said(i)]
                # a table without rows leaves no trace, an empty list or heading leaves a break
                if lines or name != "table":
                    yield _BREAK, ""
                    yield from ((_LINE, line) for line in lines)
                    yield _BREAK, ""
            elif self.structures[behind] > self.structures[i + 1]:
                behind = i + 1  # enter it
            elif name in BLOCKS:
                yield _LINE, self.said(i)
                yield _BREAK, ""
            else:
                yield _RUN, self.said(i)
            i = behind


def html_to_text(html: str | None) -> str:
    """Structured text: rows of tables joined by ` | `, list items after `-` or their number, headings set apart.

    Null and empty input give empty text; script and style are dropped; a comment or declaration counts as text only
    where it stands between blocks, as in the format's definition.
    """
    if not html:
        return ""
    lines: list[str] = []
    for kind, text in _Scan(html).pieces():
        if kind == _BREAK:
            lines.append("")
        elif text and kind == _RUN and lines and lines[-1] and lines[-1][-1] != "|":
            lines[-1] = f"{lines[-1]} {text}"
        elif text:
            lines.append(text)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def extract_links(html: str | None) -> list[tuple[str, str]]:
    """Distinct (href, text) of the anchors in order, without fragments, mail and telephone links."""
    if not html:
        return []
    found = dict.fromkeys(((a.attrs.get("href") or "").strip(), clean_line(a.text())) for a in parse(html).find_all("a") if "href" in a.attrs)
    return [(h, t) for h, t in found if h and not h.startswith(("#", "mailto:", "tel:"))]


LINKS = types.ArrayType(types.StructType([types.StructField("href", types.StringType()), types.StructField("text", types.StringType())]))


@F.pandas_udf(types.StringType())
def _text_udf(html: pd.Series) -> pd.Series:
    return html.map(html_to_text, na_action="ignore")


@F.pandas_udf(LINKS)
def _links_udf(html: pd.Series) -> pd.Series:
    return html.map(lambda h: [{"href": a, "text": b} for a, b in extract_links(h)], na_action="ignore")


#: What a text must hold for the parser to make anything of it.
_TAGGED = r"<[A-Za-z/!?]|&[#A-Za-z]"


def text_of_html(c: Column) -> Column:
    """html_to_text of a column. A text without tags and references is one line of its own and stays in the JVM."""
    tagged = c.rlike(_TAGGED)
    plain = T.strip(F.regexp_replace(T.clean(c), r"\n{3,}", "\n\n"))
    return F.when(tagged, _text_udf(F.when(tagged, c))).otherwise(F.coalesce(plain, F.lit("")))


def links_of_html(c: Column) -> Column:
    """extract_links of a column; only texts with an anchor go to Python."""
    linked = c.rlike(r"(?i)<a[\s/>]")
    return F.when(linked, _links_udf(F.when(linked, c))).otherwise(F.array().cast(LINKS))
