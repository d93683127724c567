"""Markup residue in text: finding its kinds and turning it into clean text that keeps structure.

Residue of all kinds makes one tree: elements of HTML, and a node for each construct of the other kinds. Composite text
density (link-adjusted characters per tag, summed over children) selects the content there; what lies beside it is
kept only where it says something outside links. Markdown, wiki and LaTeX residue is then rewritten in place. Headings stay lines of
their own, items start with `-` or a number, cells are joined by ` | `, code and formulas keep their text.
"""

from __future__ import annotations

import html as entities
import html.entities as entity_names
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.functions.html import HEADINGS, LISTS, STRUCTURE, Node, clean_line, parse

KINDS = ("html", "markdown", "wiki", "latex")

#: Names of HTML elements, and of wiki tags that look like them.
_TAGS = (
    "a abbr address article aside b big blockquote body br button caption center cite code col colgroup dd del details dfn div dl dt em fieldset figcaption figure font footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main mark meta nav noscript object ol option p param picture pre q s samp script section select "
    "small source span strike strong style sub summary sup svg table tbody td textarea tfoot th thead time title tr tt u ul var video wbr"
)
_WIKI_TAGS = "ref references nowiki gallery includeonly noinclude onlyinclude syntaxhighlight"

_TAG = rf"</?(?:{'|'.join(_TAGS.split())})(?=[\s/>])[^<>]*>"
_HTML = re.compile(rf"(?i){_TAG}|<!--|<!doctype\b|&(?:#\d{{1,7}}|#x[0-9a-f]{{1,6}}|[a-z][a-z0-9]{{1,30}});")
_HTML_REF = re.compile(r"(?i)&(?:#\d{1,7}|#x[0-9a-f]{1,6}|([a-z][a-z0-9]{1,30}));")

_WIKI = re.compile(
    rf"""(?mx)
    \[\[[^\[\]\n]+\]\]                              # link
  | \{{\{{[^{{}}\n]+\}}\}}                          # template
  | (?<!')'{{2,5}}(?=[^'\s])[^\n]*?[^'\s]'{{2,5}}(?!')  # bold and italic
  | \[(?:https?:)?//[^\s\[\]]+(?:\ [^\[\]\n]+)?\](?!\()  # external link
  | ^\ *={{2,6}}[ ]*[^=\s][^=\n]*?[ ]*={{2,6}}[ ]*$  # heading
  | ^\ *\{{\|                                       # table
  | ^\ *\|\}}[ ]*$
  | ^\ *\|-+[ ]*$
  | ^\ *\|[^\n]*\|\|
  | ^\ *![^\n]*!!
  | (?<![A-Za-z0-9_])__[A-Z]{{3,}}__(?![A-Za-z0-9_])   # switch
  | (?i:</?(?:{'|'.join(_WIKI_TAGS.split())})(?=[\s/>])[^<>]*>)
  """
)
_MARKDOWN = re.compile(
    r"""(?mx)
    ^\ {0,3}\#{1,6}[ ]+\S                           # heading
  | ^\ {0,3}(?:={3,}|-{3,}|_{3,}|\*{3,})[ ]*$       # underline of a heading, rule
  | ^\ {0,3}>\ ?[A-Za-z0-9"'(\[*_`>£]               # quotation
  | ^\ {0,3}(?:`{3,}|~{3,})                         # code
  | `[^`\n]+`
  | ^\ *\+[ ]+\S                                    # item
  | ^\ *(?:[-*+]|\d+[.)])[ ]+\[[ xX]\][ ]           # task
  | (?<![\w*])\*\*(?=[^\s*])[^\n]*?[^\s*]\*\*(?![\w*])|\*\*\*(?=[^\s*])[^\n]*?[^\s*]\*\*\*
  | (?<![\w_])__(?=[^\s_])(?![A-Z]{3,}__)[^\n]*?[^\s_]__(?![\w_])
  | (?<![\w*\\])\*(?=[^\s*])[^*\n]*[^\s*]\*(?![\w*])
  | (?<![\w_\\{$])_(?=[^\s_])[^_\n]*[^\s_]_(?![\w_])
  | ~~(?=\S)[^~\n]*\S~~
  | !?(?<!\[)\[[^\[\]\n]+\]\((?:[^()\s]|\([^()\s]*\))+(?:\ "[^"\n]*")?\)      # link, image
  | (?<!\[)\[[^\[\]\n]+\]\[[^\[\]\n]*\]             # link by reference
  | \[\^[^\[\]\s]+\]                                # footnote
  | ^\ {0,3}\[[^\[\]\n]+\]:\ \S
  | ^\ *\|?\ *:?-{3,}:?\ *(?:\|\ *:?-{3,}:?\ *)+\|?\ *$   # table
  | <(?:https?|mailto):[^<>\s]+>
  """
)
_PIPED = re.compile(r"(?m)^ *\|(?!\|)[^\n]*[^|\n]\| *$")
_LATEX = re.compile(
    r"""(?mx)
    (?<!\\)\\[A-Za-z]{1,24}\*?(?=[\s{\[\d£$^_(),.;:}\\]|$)    # command; paths are gone by now
  | \\begin\{|\\end\{
  | (?<![\w\\$])\$\$?(?=[^\s$])[^$\n]*[\\^_{}=+*/<>][^$\n]*(?<=[^\s\\$])\$\$?(?![\w$])    # formula
  | (?<![\w\\$])\$[A-Za-z]\$(?![\w$])
  | \\\[\s|\\\(\s*\S|\s\\\]|\\\)
  | \\\\[ ]*$
  | (?<![\w:\\])\\[%&\#_{}](?!\w*\\)|(?<=\d)\\%
  """
)
_PATH = re.compile(r"\b[A-Za-z]:\\[^\s\"'<>|]*")

#: A text without any of these has no residue; tested in the JVM so that plain texts never reach Python. Every pattern
#: of a kind needs one of them: brackets, braces, marks that no plain form uses, doubled quotes, stars, lines and equal
#: signs, a star or line before a word, and at the start of a line its marks or the colon of a column.
TRIGGER = r"(?m)[<`~\\{}\[\]$^]|&[#A-Za-z]|''|\*\*|__|(?<!\w)[*_]\S|==|^\s*(?:#|>|\+|\||!|:?-{3}|[=_*-]{3,})"


def kinds_of(text: str) -> list[str]:
    """Kinds of markup residue in a text, in the order of KINDS.

    Comparisons, arithmetic, ampersands, currency signs, underscored names, file paths, single braces, and the plain
    forms of lists and tables are not residue.
    """
    if not text:
        return []
    text = _PATH.sub("path", text)
    found = []
    if any(m[0][0] == "<" or m[0][1] == "#" or m[0][1:] in entity_names.html5 for m in _HTML.finditer(text)):
        found.append("html")
    bare = re.sub(rf"(?is)<!--.*?(?:-->|$)|{_TAG}", " ", text)
    bare = re.sub(r"(?i)&#?\w{1,30};", "-", bare)
    formulas = bool(_LATEX.search(bare))
    wiki = bool(_WIKI.search(bare))
    # wiki tables, lists and formulas would pass for Markdown
    rest = bare
    if wiki:
        rest = re.sub(r"(?ms)^ *\{\|.*?(?:^ *\|\}|\Z)", "", rest)
        rest = re.sub(r"(?m)^[*#:;]+ *(?=\[\[|\{\{|'')", "- ", rest)
        rest = _WIKI.sub(" w ", rest)
    if formulas:
        rest = re.sub(r"(?s)\$\$?(?=\S)[^$\n]+\$\$?|\\\[.*?\\\]|\\\(.*?\\\)", " f ", rest)
        rest = re.sub(r"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?(?:\{[^{}\n]*\})*|\\.", " c ", rest)
    piped = _PIPED.search(rest) and not re.search(r"(?m)^ *(?:\{\||\|\}|\|-+ *$)|\|\|", bare)
    if _MARKDOWN.search(rest) or piped:
        found.append("markdown")
    if wiki:
        found.append("wiki")
    if formulas:
        found.append("latex")
    return found


# --------------------------------------------------------------------------- HTML by composite text density


class _Density:
    """Composite text density of every node: characters per tag, lowered where much of the text is in links."""

    def __init__(self, root: Node):
        self.root = root
        self.size: dict[int, tuple[int, int, int, int]] = {}
        self.parent: dict[int, Node] = {}
        order = [root, *root.walk()]
        for node in reversed(order):
            chars = sum(len(c.strip()) for c in node.children if isinstance(c, str))
            tags = link_chars = link_tags = 0
            for c in node.children:
                if isinstance(c, Node):
                    a, b, la, lb = self.size[id(c)]
                    chars, tags, link_chars, link_tags = chars + a, tags + b + 1, link_chars + la, link_tags + lb + (c.name == "a")
                    self.parent[id(c)] = node
            if node.name == "a":
                link_chars = chars
            self.size[id(node)] = chars, tags, link_chars, link_tags
        body_chars, _, body_links, _ = self.size[id(root)]
        self.share = body_links / max(1, body_chars)
        self.of = {id(n): self._density(n) for n in order}
        # text directly in a node counts as a child of its own
        self.sum = {
            id(n): sum(self.of[id(c)] if isinstance(c, Node) else len(c.strip()) for c in n.children) for n in order
        }
        self.order = order

    def _density(self, node: Node) -> float:
        chars, tags, link_chars, link_tags = self.size[id(node)]
        if not chars:
            return 0.0
        plain = max(1, chars - link_chars)
        base = math.log(chars / plain * link_chars + self.share * chars + math.e)
        weight = math.log(max(chars / max(1, link_chars) * max(1, tags) / max(1, link_tags), math.e)) / base
        return chars / max(1, tags) * weight

    def content(self) -> tuple[Node, float]:
        """The node with the greatest sum of child densities among those that reach the threshold, and the threshold:
        the least density on the path from the body to the densest node."""
        at = max(self.order, key=lambda n: self.of[id(n)])
        threshold = self.of[id(at)]
        while at is not self.root:
            at = self.parent[id(at)]
            threshold = min(threshold, self.of[id(at)])
        dense = [n for n in self.order if self.of[id(n)] >= threshold] or [self.root]
        return max(dense, key=lambda n: self.sum[id(n)]), threshold

    def selection(self) -> tuple[set[int], tuple[int, int, int]]:
        """Subtrees to drop, and the characters selected, kept beside the selection, and dropped.

        The subtree of the greatest sum is selected. Beside it, a part goes if it is below the threshold and mostly
        links; what else is there (a heading, a short sentence, plain text around a fragment) is kept, so that no
        sentence is lost.
        """
        content, threshold = self.content()
        path = {id(content)}
        at = content
        while at is not self.root:
            at = self.parent[id(at)]
            path.add(id(at))
        drop: set[int] = set()
        dropped = 0
        work = [self.root]
        while work:
            for n in work.pop().children:
                if not isinstance(n, Node) or n is content:
                    continue
                chars, _, link_chars, link_tags = self.size[id(n)]
                if id(n) not in path and self.of[id(n)] < threshold and link_tags > 1 and 2 * link_chars > chars:
                    drop.add(id(n))
                    dropped += chars
                else:
                    work.append(n)
        total, selected = self.size[id(self.root)][0], self.size[id(content)][0]
        return drop, (selected, total - selected - dropped, dropped)


_SKIP = frozenset(["script", "style", "head", "noscript", "template"])


def _inline(node: Node) -> str:
    """Text of a node as it runs on, breaks as line ends."""
    parts: list[str] = []
    work: list[Node | str] = list(reversed(node.children))
    while work:
        x = work.pop()
        if isinstance(x, str):
            parts.append(x)
        elif x.name == "br":
            parts.append("\n")
        elif x.name not in _SKIP:
            work.extend(reversed(x.children))
    return "".join(parts)


_APART = ("header", "footer", "nav", "aside", "main", "dl", "dt", "dd", "figure", "body", "html")


def _render(root: Node, drop: set[int]) -> list[str]:
    """Lines of a tree without the subtrees to drop. Breaks that are due after an element wait among its siblings, so
    that any depth of nesting is the same."""
    out = [""]
    work: list[Node | str | tuple[str, ...]] = list(reversed(root.children))
    while work:
        x = work.pop()
        if isinstance(x, tuple):
            out += x
        elif isinstance(x, str):
            out[-1] += x
        elif id(x) in drop or x.name in _SKIP:
            continue
        elif x.name == "table":
            rows = [[clean_line(_inline(c).replace("\n", " ")) for c in tr.children if isinstance(c, Node) and c.name in ("td", "th")] for tr in x.find_all("tr")]
            out += ["", *(" | ".join(r) for r in rows if any(r)), ""]
        elif x.name in LISTS:
            out.append("")
            for n, li in enumerate(x.find_all("li"), 1):
                own = Node("li", {}, [c for c in li.children if not (isinstance(c, Node) and (c.name == "li" or c.name in LISTS))])
                out.append(f"{'-' if x.name == 'ul' else f'{n}.'} {clean_line(_inline(own))}")
            out.append("")
            loose = [c for c in x.children if isinstance(c, str) and c.strip() or isinstance(c, Node) and c.name != "li" and c.name not in LISTS]
            if loose:
                work += [("",), *reversed(loose)]
        elif x.name == "br":
            out.append("")
        elif x.name == "pre" and "\n" in _inline(x):
            out += ["", *_inline(x).strip("\n").split("\n"), ""]
        elif x.name in HEADINGS or x.name in STRUCTURE or x.name in _APART:
            gap = ("", "") if x.name in STRUCTURE else ("",)
            out += gap
            work += [gap, *reversed(x.children)]
        else:
            work += reversed(x.children)
    return out


_CLOSABLE = re.compile(r"(?i)<(/?)(ul|ol|table|pre|a|h[1-6])(?=[\s>])[^<>]*>")


def _closed(text: str) -> str:
    """text with the end tags that lists, tables, code, links and headings lack, set where the paragraph ends (the
    line, for headings and links), so that an element left open doesn't take in what follows it."""
    waiting: list[tuple[str, int]] = []
    for m in _CLOSABLE.finditer(text):
        name = m[2].lower()
        if not m[1]:
            waiting.append((name, m.end()))
        else:
            at = next((i for i in range(len(waiting) - 1, -1, -1) if waiting[i][0] == name), None)
            if at is not None:
                del waiting[at]
    for name, at in reversed(waiting):
        stop = re.compile(r"\n" if name[0] in "ha" else r"\n\s*\n").search(text, at)
        end = stop.start() if stop else len(text)
        text = f"{text[:end]}</{name}>{text[end:]}"
    return text


def _html_tree(text: str) -> Node | None:
    """Tree of a text that holds elements; null if it holds character references only."""
    if not re.search(rf"(?i){_TAG}|<!--|<!doctype", text):
        return None
    # what isn't a tag must not be read as one
    text = re.sub(rf"(?i)<(?!/?(?:{'|'.join(_TAGS.split())})(?=[\s/>])|!--|!doctype)", "&lt;", text)
    return parse(_closed(text))


def _grafted(root: Node, patterns: list[re.Pattern[str]]) -> Node:
    """A copy of the tree's shape for the density: each construct of the other kinds in its texts as a node, links as
    links."""

    def graft(s: str) -> list[Node | str]:
        spans = sorted((m.span() for p in patterns for m in p.finditer(s)), key=lambda x: (x[0], -x[1]))
        out: list[Node | str] = []
        at = 0
        for a, b in spans:
            if a < at:
                continue
            link = s[a : a + 2] in ("[[", "![") or s[a] == "[" or s[a] == "<"
            out += [s[at:a], Node("a" if link else "mark", {}, [s[a:b]])]
            at = b
        return [*out, s[at:]]

    for node in [root, *root.walk()]:
        node.children = [x for c in node.children for x in (graft(c) if isinstance(c, str) else [c])]
    return root


def density(text: str, kinds: list[str]) -> tuple[set[int], Node | None, tuple[int, int, int]]:
    """Subtrees to drop, the tree of the HTML, and the characters selected, kept beside and dropped, of a text with
    residue of these kinds. Without HTML there is nothing to drop, as a construct of another kind is no part of a page."""
    tree = _html_tree(text) if "html" in kinds else None
    others = [p for kind, p in (("wiki", _WIKI), ("markdown", _MARKDOWN), ("latex", _LATEX)) if kind in kinds]
    if tree is not None:
        drop, counts = _Density(tree).selection()
        return drop, tree, counts
    return set(), None, _Density(_grafted(Node("", {}, [text]), others)).selection()[1]


def _unescaped(text: str) -> str:
    """A page that was escaped once too often, as it was meant."""
    return entities.unescape(text) if re.search(rf"(?i)&lt;(?:/|{'|'.join(_TAGS.split())})\b", text) else text


# --------------------------------------------------------------------------- the other kinds


def _piped(line: str) -> str:
    return " | ".join(clean_line(c) for c in re.split(r"\|\||!!|\|", line.strip().strip("|!").strip()))


def _from_wiki(text: str) -> str:
    def table(m: re.Match[str]) -> str:
        rows, row = [], []
        for line in m[0].split("\n")[1:]:
            line = line.strip()
            if line.startswith(("|-", "|}")):
                rows.append(row)
                row = []
            elif line.startswith(("|", "!")):
                row += [clean_line(re.sub(r"^[^|\[\]{}]*=[^|]*\|(?!\|)", "", c)) for c in re.split(r"\|\||!!", line[1:])]
        return "\n".join(" | ".join(r) for r in [*rows, row] if any(r))

    text = re.sub(r"(?ms)^ *\{\|.*?(?:^ *\|\} *$|\Z)", table, text)
    text = re.sub(r"(?m)^ *(={2,6}) *([^=\n]+?) *\1 *$", r"\n\2\n", text)
    for _ in range(3):
        text = re.sub(r"\{\{([^{}\n]*)\}\}", lambda m: m[1].split("|", 1)[1] if "|" in m[1] and not re.match(r"(?i)cite|ref|fn", m[1]) else "", text)
    text = re.sub(r"\[\[([^\[\]\n]*)\]\]", lambda m: m[1].rsplit("|", 1)[-1].lstrip(":"), text)
    text = re.sub(r"\[(?:https?:)?//[^\s\[\]]+ ?([^\[\]\n]*)\](?!\()", r"\1", text)
    text = re.sub(r"(?i)<ref[^<>]*/>|<ref[^<>]*>.*?</ref>", "", text)
    text = re.sub(rf"(?i)</?(?:{'|'.join(_WIKI_TAGS.split())})[^<>]*>", "", text)
    text = re.sub(r"(?<![A-Za-z0-9_])__[A-Z]{3,}__(?![A-Za-z0-9_])", "", text)
    text = re.sub(r"(?<!')'{2,5}(?=[^'\s])([^\n]*?[^'\s])'{2,5}(?!')", r"\1", text)
    text = re.sub(r"(?m)^\*+ *", "- ", text)
    text = re.sub(r"(?m)^#+ *(?=\S)", "- ", text)
    return re.sub(r"(?m)^ *\|\}? *$|^ *\|-+ *$", "", re.sub(r"(?m)^ *[|!] ?[^\n]*(?:\|\||!!)[^\n]*$", lambda m: _piped(m[0]), text))


def _from_markdown(text: str) -> str:
    kept: list[str] = []

    def keep(s: str) -> str:
        kept.append(s)
        return f"\x00{len(kept) - 1}\x00"

    text = re.sub(r"(?ms)^ {0,3}(`{3,}|~{3,})[^\n]*\n(.*?)(?:^ {0,3}\1 *$|\Z)", lambda m: keep(m[2].rstrip("\n")), text)
    text = re.sub(r"`([^`\n]+)`", lambda m: keep(m[1]), text)
    text = re.sub(r"(?m)^ {0,3}#{1,6} +(.*?) *#* *$", r"\n\1\n", text)
    text = re.sub(r"(?m)^ {0,3}(?:={3,}|-{3,}|_{3,}|\*{3,}) *$", "", text)
    text = re.sub(r"(?m)^ {0,3}(?:> ?)+", "", text)
    text = re.sub(r"(?m)^ *\|?[ :|-]*-{3,}[ :|-]*$\n?", "", text)
    text = re.sub(r"(?m)^ *\|([^\n]*)\| *$", lambda m: _piped(m[0]), text)
    text = re.sub(r"(?m)^( *)(?:[-*+]|(\d+)[.)]) +\[[ xX]\] +", lambda m: f"{m[2]}. " if m[2] else "- ", text)
    text = re.sub(r"(?m)^ *\+ +", "- ", text)
    text = re.sub(r"(?m)^ {0,3}\[[^\[\]\n]+\]: \S[^\n]*$", "", text)
    text = re.sub(r"\[\^[^\[\]\s]+\]", "", text)
    text = re.sub(r"!?\[([^\[\]\n]*)\]\((?:[^()\s]|\([^()\s]*\))*(?: \"[^\"\n]*\")?\)", r"\1", text)
    text = re.sub(r"\[([^\[\]\n]+)\]\[[^\[\]\n]*\]", r"\1", text)
    text = re.sub(r"<((?:https?|mailto):[^<>\s]+)>", r"\1", text)
    for mark in (r"\*\*\*", r"\*\*", "__", "~~"):
        text = re.sub(rf"(?<![\w]){mark}(?=\S)([^\n]*?\S){mark}(?!\w)", r"\1", text)
    text = re.sub(r"(?<![\w*\\])\*(?=[^\s*])([^*\n]*[^\s*])\*(?![\w*])", r"\1", text)
    text = re.sub(r"(?<![\w_\\])_(?=[^\s_])([^_\n]*[^\s_])_(?![\w_])", r"\1", text)
    return re.sub(r"\x00(\d+)\x00", lambda m: kept[int(m[1])], text)


def _from_latex(text: str) -> str:
    """Commands off, their arguments kept; formulas stay as they are, between dollar signs or not, without them."""
    kept: list[str] = []

    def keep(m: re.Match[str]) -> str:
        kept.append(m[1].strip())
        return f"\x00{len(kept) - 1}\x00"

    text = _PATH.sub(lambda m: keep(re.match(r"(?s)(.*)", m[0])), text)
    text = re.sub(r"(?<![\w\\])\$\$?(?=\S)([^$\n]+?)(?<=\S)\$\$?(?!\w)", keep, text)
    text = re.sub(r"(?s)\\\[(.*?)\\\]", keep, text)
    text = re.sub(r"(?s)\\\((.*?)\\\)", keep, text)
    text = re.sub(r"(?s)\\begin\{(?:equation|align|math|displaymath)\*?\}(.*?)\\end\{[a-z]+\*?\}", keep, text)
    text = re.sub(r"(?s)\\begin\{tabular\}(?:\{[^{}]*\})?(.*?)(?:\\end\{tabular\}|\Z)", lambda m: "\n".join(re.sub(r"\s*(?<!\\)&\s*", " | ", r.strip()) for r in re.split(r"\\\\", m[1]) if r.strip()), text)
    text = re.sub(r"(?m)\\(?:section|subsection|subsubsection|chapter|paragraph|subparagraph)\*?\{([^{}\n]*)\}", r"\n\n\1\n\n", text)
    text = re.sub(r"(?m)^ *\\item(?:\[[^\]\n]*\])? *", "- ", text)
    text = re.sub(r"\\(?:begin|end)\{[^{}\n]*\}(?:\[[^\]\n]*\]|\{[^{}\n]*\})*", "", text)
    text = re.sub(r"~?\\(?:ref|eqref|pageref|cite[a-z]*|label|footnotemark|index)\*?(?:\[[^\]\n]*\])?\{[^{}\n]*\}", "", text)
    text = re.sub(r"\\footnote\{([^{}\n]*)\}", r" (\1)", text)
    text = re.sub(r"\\pounds\b\s*", "£", text)
    for _ in range(4):
        text = re.sub(r"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{([^{}\n]*)\}", r"\1", text)
    text = re.sub(r"\\([%&#_{}$£])", r"\1", text)
    text = re.sub(r"(?m)^(.*)\\\\ *$", lambda m: re.sub(r"\s+&\s+", " | ", m[1].rstrip()), text)
    text = re.sub(r"(?<![\w:\\])\\[A-Za-z]+\*?\s?", "", text)
    return re.sub(r"\x00(\d+)\x00", lambda m: kept[int(m[1])], text)


def cleaned(text: str) -> tuple[str, list[str], tuple[int, int, int]]:
    """(clean text, kinds of residue, characters selected by density, kept beside the selection, and dropped). Text
    without residue comes back as it is, all of it selected."""
    kinds = kinds_of(text)
    if not kinds:
        return text, kinds, (len(text), 0, 0)
    if "html" in kinds:
        text = _unescaped(text)
    drop, tree, counts = density(text, kinds)
    if tree is not None:
        text = "\n".join(_render(tree, drop))
    elif "html" in kinds:
        text = entities.unescape(text)
    for kind, convert in (("wiki", _from_wiki), ("latex", _from_latex), ("markdown", _from_markdown)):
        if kind in kinds:
            text = convert(text)
    lines = [clean_line(line) if not line.startswith("    ") else line.rstrip() for line in text.split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip(), kinds, counts


def clean_text(text: str) -> tuple[str, list[str]]:
    """(clean text, kinds of residue)."""
    return cleaned(text)[:2]


# --------------------------------------------------------------------------- plan


COUNTS = ("selected", "beside", "dropped")


def markup(docs: DataFrame, id_column: str, text_column: str = "text") -> DataFrame:
    """(id, clean, kinds, selected, beside, dropped) of every row whose text isn't null; kinds is empty where nothing was
    changed. The last three are the characters the density selected, those kept beside the selection, and those dropped.

    Texts without any character that could begin residue pass through the JVM untouched; only the others go to
    Python, in Arrow batches. One narrow pass, no shuffle, whole texts.
    """
    rows = docs.select(id_column, F.col(text_column).alias("clean")).filter("clean is not null")
    suspect = F.col("clean").rlike(TRIGGER)

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [cleaned(t) for t in batch["clean"]]
            counts = {name: [c[i] for _, _, c in done] for i, name in enumerate(COUNTS)}
            yield pd.DataFrame({id_column: batch[id_column], "clean": [t for t, _, _ in done], "kinds": [k for _, k, _ in done], **counts})

    kind = docs.schema[id_column].dataType.simpleString()
    changed = rows.filter(suspect).mapInPandas(convert, f"{id_column} {kind}, clean string, kinds array<string>, {', '.join(f'{c} int' for c in COUNTS)}")
    none = F.lit(0)
    plain = rows.filter(~suspect).select(id_column, "clean", F.array().cast("array<string>").alias("kinds"), F.length("clean").alias("selected"), none.alias("beside"), none.alias("dropped"))
    return plain.unionByName(changed)
