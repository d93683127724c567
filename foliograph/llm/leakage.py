"""Evaluation items leaking into a corpus: one automaton over the items, one scan over each text."""

from __future__ import annotations

import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from math import ceil

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_GAP = re.compile(r"[\W_]+")
_WORD = re.compile(r"[^\W_]+")

#: Words of a pattern; runs of agreeing words shorter than this occur in stock phrases.
WINDOW = 5
#: Words that may be changed, added or dropped between two runs of one stretch, and the least run on the far side.
SLACK, FAR_RUN = 2, 3
#: Agreeing words a stretch of a long item needs, and their share of its words. Two texts made to one pattern agree in
#: the fixed words only, which is less.
STRETCH, DENSITY = 10, 0.85
#: Characters of items in one automaton, about 250 bytes of memory each; more items are scanned for in blocks.
BLOCK_CHARS = 2_000_000


def normal(text: str) -> str:
    """Lower case, words parted by single blanks, one at either end."""
    return f" {_GAP.sub(' ', text.lower()).strip()} "


class Items:
    """Automaton over word windows of the items' texts and over their answers."""

    def __init__(self, rows: list[tuple[int, str, str]], window: int = WINDOW):
        self.words = {item: normal(text).split() for item, text, _ in rows}
        self.answers = {item: normal(answer).split() for item, _, answer in rows}
        patterns: dict[str, list[tuple[int, int]]] = {}
        for item, words in self.words.items():
            size = min(window, len(words))
            for at in range(len(words) - size + 1) if size else ():
                patterns.setdefault(f" {' '.join(words[at : at + size])} ", []).append((item, at))
        for item, words in self.answers.items():
            if words:
                patterns.setdefault(f" {' '.join(words)} ", []).append((item, -1))
        self.automaton = ahocorasick.Automaton()
        for pattern, uses in patterns.items():
            self.automaton.add_word(pattern, (len(pattern), uses))
        if patterns:
            self.automaton.make_automaton()
        self.empty = not patterns

    def leaks(self, text: str, share: float) -> list[tuple[int, float, int, int, bool]]:
        """(item, share of its words found, start, end, whether its answer follows), with offsets in the text."""
        if self.empty:
            return []
        flat = normal(text)
        hits: dict[int, set[tuple[int, int]]] = {}
        answers: dict[int, int] = {}
        for end, (length, uses) in self.automaton.iter(flat):
            start = end - length + 1
            for item, at in uses:
                if at < 0:
                    answers[item] = max(answers.get(item, -1), start)
                else:
                    hits.setdefault(item, set()).add((start, at))
        out = []
        words: list[str] = []
        starts: list[int] = []
        for item, found in hits.items():
            target = self.words[item]
            if not words:
                words = flat.split()
                starts = [0, *accumulate(len(w) + 1 for w in words)]
            seeds = sorted((bisect_right(starts, s) - 1, at) for s, at in found)
            covered, first, last = _chain(_stretches(words, target, seeds, least_stretch(len(target), share)), len(target))
            if covered >= share * len(target):
                a, b = _offsets(text, first, last, len(words))
                out.append((item, round(covered / len(target), 4), a, b, answers.get(item, -1) >= starts[first]))
        return out


def _offsets(text: str, first: int, last: int, count: int) -> tuple[int, int]:
    """Offsets in the original of the words first to last."""
    spans = [m.span() for m in _WORD.finditer(text)]
    if len(spans) != count:  # a letter whose lower case has other word breaks
        spans = [m.span() for m in _WORD.finditer(text.lower())]
        spans = [(min(a, len(text)), min(b, len(text))) for a, b in spans]
    return spans[first][0], spans[last][1]


def _run(words: list[str], target: list[str], i: int, j: int) -> int:
    n = 0
    while i + n < len(words) and j + n < len(target) and words[i + n] == target[j + n]:
        n += 1
    return n


def _back(words: list[str], target: list[str], i: int, j: int) -> int:
    n = 0
    while i - n > 0 and j - n > 0 and words[i - n - 1] == target[j - n - 1]:
        n += 1
    return n


_SHIFTS = sorted(((a, b) for a in range(SLACK + 1) for b in range(SLACK + 1) if a or b), key=lambda s: (s[0] + s[1], s))


def least_stretch(size: int, share: float) -> int:
    """Agreeing words that make a stretch of an item of `size` words: STRETCH, or the share asked for of a short item,
    but a window at least (the whole of an item shorter than that)."""
    return min(STRETCH, max(WINDOW, ceil(share * size)), size)


def _stretches(words: list[str], target: list[str], seeds: list[tuple[int, int]], least: int) -> list[tuple[int, int, int, int]]:
    """(target from, to, word from, to) of maximal stretches: exact runs from the seeds, carried on both ways over
    gaps of up to SLACK words on either side. Only those with `least` agreeing words count."""
    out: list[tuple[int, int, int, int]] = []
    done: set[tuple[int, int]] = set()
    for i, j in seeds:
        if (i, j) in done:
            continue
        back = _back(words, target, i, j)
        lo_i, lo_j = i - back, j - back
        n = _run(words, target, lo_i, lo_j)
        done.update((lo_i + k, lo_j + k) for k in range(n))
        hi_i, hi_j, agree = lo_i + n, lo_j + n, n
        moved = True
        while moved:
            moved = False
            for a, b in _SHIFTS:
                m = _run(words, target, hi_i + a, hi_j + b)
                if (m >= FAR_RUN or m and hi_j + b + m == len(target)) and agree + m >= DENSITY * (hi_j + b + m - lo_j):
                    done.update((hi_i + a + k, hi_j + b + k) for k in range(m))
                    hi_i, hi_j, agree, moved = hi_i + a + m, hi_j + b + m, agree + m, True
                    break
        moved = True
        while moved:
            moved = False
            for a, b in _SHIFTS:
                if lo_i - a < 0 or lo_j - b < 0:
                    continue
                m = _back(words, target, lo_i - a, lo_j - b)
                if (m >= FAR_RUN or m and lo_j - b - m == 0) and agree + m >= DENSITY * (hi_j - lo_j + b + m):
                    lo_i, lo_j, agree, moved = lo_i - a - m, lo_j - b - m, agree + m, True
                    break
        if agree >= least:
            out.append((lo_j, hi_j, lo_i, hi_i))
    return sorted(set(out))


def _chain(stretches: list[tuple[int, int, int, int]], size: int) -> tuple[int, int, int]:
    """Most words of the item covered by stretches that follow each other in both texts, and the words they span."""
    best: list[tuple[int, int, int]] = []
    for n, (a, b, c, d) in enumerate(stretches):
        here = (b - a, c, d - 1)
        for m in range(n):
            a2, b2, c2, d2 = stretches[m]
            overlap = max(0, b2 - a, d2 - c)
            if a2 < a and c2 < c and b2 < b and overlap < b - a and best[m][0] + b - a - overlap > here[0]:
                here = (best[m][0] + b - a - overlap, best[m][1], max(best[m][2], d - 1))
        best.append(here)
    return max(best, default=(0, 0, 0))


SCHEMA = "item_id bigint, doc_id bigint, share double, start int, end int, answer_follows boolean"


def find_leaks(documents: DataFrame, items: DataFrame, share: float = 1 / 3, max_chars: int = 64_000_000) -> DataFrame:
    """(item_id, doc_id, share, start, end, answer_follows) of each item and document that holds enough of it.

    share is the part of the item's words that appear in stretches, in the item's order, whatever the layout, case
    and punctuation; a stretch goes on over a word or two changed, added or dropped. start and end are offsets in the
    original text. Null and empty texts and items leak nowhere; copies count each.

    The held-out items are a bounded set: their texts are collected, and more than max_chars characters of them are an
    error. Documents are read in one narrow pass without shuffle, each text as a whole; items that exceed one
    automaton's budget of BLOCK_CHARS take a pass for each such block, so that a worker never holds two automata.
    """
    blocks: list[list[tuple[int, str, str]]] = [[]]
    total = size = 0
    for item, text, reply in items.select("item_id", "text", "answer").filter("text is not null").orderBy("item_id").toLocalIterator():
        chars = len(text) + len(reply or "")
        total, size = total + chars, size + chars
        if total > max_chars:
            raise ValueError(f"more than {max_chars} characters of items")
        if size > BLOCK_CHARS and blocks[-1]:
            blocks.append([])
            size = chars
        blocks[-1].append((item, text, reply or ""))
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("text <> ''")
    out = _scan(docs, blocks[0], share)
    for block in blocks[1:]:
        out = out.unionByName(_scan(docs, block, share))
    return out


#: The automaton this worker built last.
_BUILT: dict[str, Items] = {}


def _automaton(name: str, block: Broadcast) -> Items:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Items(block.value)
    return _BUILT[name]


def _scan(docs: DataFrame, block: list[tuple[int, str, str]], share: float) -> DataFrame:
    shared, name = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _automaton(name, shared)
        for batch in batches:
            found = [(item, doc, part, a, b, answer) for doc, text in zip(batch["doc_id"], batch["text"], strict=True) for item, part, a, b, answer in known.leaks(text, share)]
            yield pd.DataFrame(found, columns=names)

    return docs.mapInPandas(scan, SCHEMA)
