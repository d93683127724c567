"""Per-document text statistics, and how far a text is from natural prose in its language."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.session import cut

LANGUAGES = ("en", "cy", "fr")

#: Statistics of a text. Shares are of characters other than blanks unless the name says lines or words.
STATISTICS = (
    "words_per_line",  # logarithm of one plus words per line that isn't blank
    "word_length",  # mean length of words
    "common_words",  # share of words that are common in the language
    "symbols",  # share of characters that are neither letters, digits nor usual punctuation
    "digits",  # share of digits
    "odd_tokens",  # share of tokens, outside rows of cells, that are no plain word, number, sum of money or reference
    "end_marks",  # share of lines that end in punctuation
    "repeated",  # share of text in sentences or lines said before
    "running",  # share in lines of five words or more with common words among them
    "brief",  # share in lines of fewer words
    "marked",  # share in lines that begin with the mark of an item or the code of a heading
    "celled",  # share in lines of cells
    "controls",  # share in lines of page controls, objects, style rules, logs and code
    "bare",  # share in lines of five words or more without common words
)
#: What a statistic that is greater than in prose speaks for. The others tell that a text is no prose, but not what it
#: is.
SPEAKS_FOR = {"list": ("brief", "marked"), "table": ("celled", "digits"), "junk": ("controls", "bare", "odd_tokens", "repeated", "symbols")}

#: Controls of web pages, in lower case.
FURNITURE = frozenset(
    "home|menu|search|contents|next|previous|next page|previous page|back to top|back|top|share|share this page|print|print this page|sign in|sign out|log in|register|cookies|cookie policy|accept cookies|"
    "accept all cookies|accessibility|accessibility statement|privacy|privacy policy|privacy notice|terms|terms and conditions|terms of use|contact|contact us|help|about|about us|feedback|skip to main content|skip to content|"
    "skip navigation|skip to navigation|navigation|main menu|site map|sitemap|follow us|subscribe|download|email|show all|hide all|show all sections|hide all sections|more|read more|loading|close|open|"
    "is this page useful?|yes|no|report a problem|report a problem with this page|all rights reserved|crown copyright|"
    "hafan|dewislen|chwilio|cynnwys|nesaf|blaenorol|yn ôl i'r brig|mewngofnodi|cwcis|hygyrchedd|accueil|rechercher|sommaire|suivant|précédent|haut de page|connexion|imprimer|partager|aide".split("|")
)

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_DIGIT = re.compile(r"\d+")
_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()\-–—’‘“”£€$%/&]")
_PLAIN = r"""[(\['"“‘«]*(?:[^\W\d_]+(?:['’\-–/&.][^\W\d_]+)*\.?|[£€$]?\d[\d.,:/\-–]*(?:%|[^\W\d_]{1,2})?|[^\W\d_]{1,8}\d{1,8}[^\W\d_]?|[&–—\-|])[)\]'"”’»]*[.,;:!?…]*[)\]'"”’»]*"""
#: A token that is no plain word, number, sum, date or reference, whatever brackets, quotes and stops surround it.
_ODD = re.compile(rf"(?<!\S)(?!{_PLAIN}(?!\S))\S+")
_ITEM = re.compile(r"[ \t]*(?:[-*+•▪◦·–—●○■‣]|\(?(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,4})[.)])[ \t]+\S")
_CODED = re.compile(r"[ \t]*[A-Z]{2,8}\d{2,8}\b[ \t]*[-–—:]?[ \t]*\S")
_END = re.compile(r"[.!?;:…][\"'”’)»]*$")
_SENTENCE = re.compile(r"(?<=[.!?;])[\"'”’)]*\s+")
_OBJECT = re.compile(r"""^\s*[\[{]\s*[\[{"]|"\s*:\s*["\[{\d]|[}\]]\s*,\s*[{\[]""")
_STYLE = re.compile(r"^[^{}]{1,80}\{\s*[\w\-]+\s*:[^{}]*\}?\s*$|^\s*[\w\-]+\s*:\s*[^;{}]+;\s*\}\s*$")
_LOG = re.compile(r"^\s*\[?\d{4}-\d\d-\d\d[T ]\d\d:\d\d|^\s*\S+=\S+(?:\s+\S+=\S+)+\s*$")
_CODE = re.compile(r"^\s*(?:function|var|let|const|import|return|if|for|while)\b.*[{};]\s*$|^\s*</?\w+[^<>]*>.*>\s*$")
_QUOTED = re.compile(r'"[^"]*"|\d,\d{3}(?!\d)')
_GAP = re.compile(r"\S(?: {2,}|\t+)(?=\S)")
_SPLIT = {"tab": re.compile(r"\t"), "bar": re.compile(r"\|"), "gap": re.compile(r" {2,}"), "comma": re.compile(r","), "semicolon": re.compile(r";")}


#: Nothing but controls, whatever parts them.
_CONTROLS = re.compile(rf"\W*(?:\b(?:{'|'.join(sorted(map(re.escape, FURNITURE), key=len, reverse=True))})(?!\w)\W*)+")


def _cells(line: str) -> list[str]:
    """Cells of a row parted by tabs, bars, wide gaps, or commas or semicolons without blanks; empty if it is none."""
    s = line.strip()
    if "\t" in s or line.count("\t") > 1:
        return _SPLIT["tab"].split(line)
    if "|" in s and (" | " in s or s[0] == "|" and s[-1] == "|" and len(s) > 2):
        return _SPLIT["bar"].split(s.strip("|"))
    if "  " in s and s[0] not in "-*•–" and len(_GAP.findall(s)) >= 2:
        return _SPLIT["gap"].split(s)
    for name, mark in (("comma", ","), ("semicolon", ";")):
        n = s.count(mark)
        if n >= 2 and (3 * s.count(mark + " ") < n or '"' in s):
            bare = _QUOTED.sub("0", s)
            if bare.count(mark) >= 2 and mark + " " not in bare and len(bare) <= 40 * (bare.count(mark) + 1):
                return _SPLIT[name].split(bare)
    return []


def _machine(s: str) -> bool:
    """Objects, style rules, logs and code."""
    if ("{" in s or "}" in s or '"' in s or s[0] == "[") and (_OBJECT.search(s) or _STYLE.search(s)):
        return True
    return ("=" in s or s[0].isdigit() or s[0] == "[") and bool(_LOG.search(s)) or s[-1] in "{};>" and bool(_CODE.search(s))


#: Lanes of a packed count: words, letters, odd tokens, digits, symbols, characters, then common words by language.
_LANE, _MASK = 40, (1 << 40) - 1
_WORDS, _LETTERS, _ODDS, _DIGITS, _SYMBOLS, _CHARS, _COMMON = range(7)


class _Tokens(dict):
    """Counts of a token packed into one integer, so that a text's counts are one sum over its tokens. Texts share
    most of their tokens; the memory of them is emptied when it has grown to `most`."""

    def __init__(self, common: list[frozenset[str]], most: int = 200_000):
        super().__init__()
        self.common, self.most = common, most

    def __missing__(self, token: str) -> int:
        words = _WORD.findall(token.lower())
        counts = [len(words), sum(map(len, words)), bool(_ODD.match(token)), sum(map(len, _DIGIT.findall(token))), len(_SYMBOL.findall(token)), len(token)]
        counts += [sum(map(c.__contains__, words)) for c in self.common]
        packed = sum(int(n) << _LANE * i for i, n in enumerate(counts))
        if len(self) >= self.most:
            self.clear()
        self[token] = packed
        return packed


def _lane(packed: int, lane: int) -> int:
    return packed >> _LANE * lane & _MASK


class Reader:
    """Measures texts. `common` has the common words of each language."""

    def __init__(self, common: dict[str, set[str]]):
        self.counts = _Tokens([frozenset(common.get(x, ())) for x in LANGUAGES])

    def measure(self, text: str) -> tuple[str, list[float]]:
        """(language, statistics)."""
        tokens = text.split()
        packed = sum(map(self.counts.__getitem__, tokens))
        n_words = _lane(packed, _WORDS)
        if not n_words:
            return "en", [float(s in ("symbols", "odd_tokens")) for s in STATISTICS]  # no words at all
        common = [_lane(packed, _COMMON + i) for i in range(len(LANGUAGES))]
        lang = max(range(len(LANGUAGES)), key=lambda i: (common[i], -i))
        lines = [x for x in text.splitlines() if x and not x.isspace()]
        size = _lane(packed, _CHARS)
        seen = _lines(lines, self.counts, _COMMON + lang)
        stats = {
            "words_per_line": float(np.log1p(n_words / len(lines))),
            "word_length": _lane(packed, _LETTERS) / n_words,
            "common_words": common[lang] / n_words,
            "symbols": _lane(packed, _SYMBOLS) / size,
            "digits": _lane(packed, _DIGITS) / size,
            "odd_tokens": seen.pop("odd") / len(tokens),
            "end_marks": sum(1 for x in lines if _END.search(x[-6:].rstrip())) / len(lines),
            "repeated": max(seen.pop("again") / size, _said_again(" ".join(tokens).lower())),
        } | {name: n / size for name, n in seen.items()}
        return LANGUAGES[lang], [stats[s] for s in STATISTICS]


def _said_again(text: str) -> float:
    """Share of the text's sentences that were said before."""
    seen: set[str] = set()
    said = again = 0
    for sentence in _SENTENCE.split(text):
        if len(sentence) >= 20:
            sentence = sentence.rstrip(".!?;: ")
            said += len(sentence)
            if sentence in seen:
                again += len(sentence)
            seen.add(sentence)
    return again / max(1, said)


def _lines(lines: list[str], counts: _Tokens, common: int) -> dict[str, int]:
    """Characters in lines of each form, those of lines outside lists and rows that were there before (`again`), and odd
    tokens outside rows. A sentence that ends in a colon goes with the items or rows it announces. common is the lane
    of the language."""
    sizes = dict.fromkeys(("running", "brief", "marked", "celled", "controls", "bare", "again", "odd"), 0)
    seen: set[str] = set()
    in_rows, lead = False, 0
    for line in lines:
        s = line.strip()
        tokens = s.split()
        packed = sum(map(counts.__getitem__, tokens))
        size, n_words, odd = _lane(packed, _CHARS), _lane(packed, _WORDS), _lane(packed, _ODDS)
        if _CONTROLS.fullmatch(s.lower()) or _machine(s):
            form = "controls"
        elif _row(line, counts) or in_rows and line[:4].isspace() and len(s) <= 60:  # also a row with one cell filled
            form, odd = "celled", 0
        else:
            fluent = _lane(packed, common) >= 0.12 * n_words
            marked = _ITEM.match(line) or _CODED.match(line) and len(s) <= 120 and not s.endswith(".")
            if marked and not (n_words >= 14 and fluent):  # an item that holds sentences is prose with a mark before it
                form = "marked"
            elif n_words < 5:
                form = "brief"
            else:
                form = "running" if fluent else "bare"
        in_rows = form == "celled"
        if lead and form in ("brief", "marked", "celled"):
            sizes["running"] -= lead
            sizes[form] += lead
        lead = size if form == "running" and s[-1] == ":" else 0
        if form in ("running", "bare", "brief") and len(s) >= 20:
            plain = s.lower().rstrip(".!?;: ")
            if plain in seen:
                sizes["again"] += size
            seen.add(plain)
        sizes[form] += size
        sizes["odd"] += odd
    return sizes


def _row(line: str, counts: _Tokens) -> bool:
    """Whether a line is a row of cells: parted as one, and at least half of its cells short and plain."""
    filled = [c.strip() for c in _cells(line) if c.strip()]
    return bool(filled) and 2 * sum(1 for c in filled if len(c) <= 60 and not any(_lane(counts[t], _ODDS) for t in c.split())) >= len(filled)


# --------------------------------------------------------------------------- plan

_LIST = ", ".join(f"{s} double" for s in STATISTICS)


def statistics(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """(doc_id, language, the STATISTICS): one row per document, in one narrow pass over whole texts.

    The language is the one whose common words are the most frequent, whatever the table says; English without any.
    Null and empty texts, and texts without words, have the values of a text that is all symbols.
    """
    rows = common_words.select("lang", "word").filter("word is not null").limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("common words are a short list by definition: at most 100,000")
    common: dict[str, set[str]] = {}
    for lang, word in rows:
        common.setdefault(lang, set()).add(word.lower())
    shared = documents.sparkSession.sparkContext.broadcast(common)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            seen = [reader.measure(t or "") for t in batch.column("text").to_pylist()]
            values = list(zip(*(s for _, s in seen), strict=True)) or [()] * len(STATISTICS)
            columns = [batch.column("doc_id"), pa.array([x for x, _ in seen], pa.string()), *(pa.array(v, pa.float64()) for v in values)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "language", *STATISTICS])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(measure, f"doc_id bigint, language string, {_LIST}")


#: Least spread of each statistic, in its own unit; prose hardly varies in some, and any trifle would count. That of `running` and of `repeated` lets half a text that doesn't run on, or is said again, reach the cutoff;
#: the other forms of lines share what isn't running and have twice that, so that they tell the kind rather than count
#: the same lines twice.
LEAST_SPREAD = dict(zip(STATISTICS, (0.8, 0.7, 0.11, 0.05, 0.1, 0.09, 0.4, 0.085, 0.105, *(0.22,) * 5), strict=True))


def prose_model(stats: DataFrame, core_width: float = 4.0, prior_rows: float = 200.0) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Robust mean and inverse covariance of prose, by language.

    Medians and quartile ranges over all documents give the centre; documents within core_width ranges of it in every
    statistic are the core, and its mean and covariance are the model (one reweighting step). All of it is aggregates
    over every document; the driver gets one row of sums per language. Every language's sums are joined by prior_rows
    documents of the prose of all languages together, so that a rare language leans on the others and a common one
    doesn't.
    """
    quartiles = stats.groupBy("language").agg(*(F.percentile_approx(s, [0.25, 0.5, 0.75], 10_000).alias(s) for s in STATISTICS)).collect()
    centre = {r["language"]: {s: (r[s][1], max((r[s][2] - r[s][0]) / 1.349, LEAST_SPREAD[s] / 2)) for s in STATISTICS} for r in quartiles}
    if not centre:
        return {}
    inside = F.lit(False)
    for lang, at in centre.items():
        near = F.col("language") == lang
        for s, (mid, wide) in at.items():
            near &= F.abs(F.col(s) - mid) <= core_width * wide
        inside |= near
    d = len(STATISTICS)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = [F.sum(s).alias(f"m{i}") for i, s in enumerate(STATISTICS)] + [F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"c{i}_{j}") for i, j in pairs]
    rows = {r["language"]: r for r in stats.filter(inside).groupBy("language").agg(F.count(F.lit(1)).alias("n"), *sums).collect()}

    floor = np.array([LEAST_SPREAD[s] ** 2 for s in STATISTICS])

    def moments(part: list) -> tuple[float, np.ndarray, np.ndarray]:
        n = float(sum(r["n"] for r in part))
        first = np.array([float(sum(r[f"m{i}"] for r in part)) for i in range(d)])
        second = np.zeros((d, d))
        for i, j in pairs:
            second[i, j] = second[j, i] = sum(r[f"c{i}_{j}"] for r in part)
        return n, first, second

    n_all, first_all, second_all = moments(list(rows.values()))
    if not n_all:  # no document within the core: the medians alone
        n_all, first_all = 1.0, np.array([centre[min(centre)][s][0] for s in STATISTICS])
        second_all = np.outer(first_all, first_all)
    out = {}
    for lang in centre:
        n, first, second = moments([rows[lang]] if lang in rows else [])
        mean = (first + prior_rows * first_all / n_all) / (n + prior_rows)
        cov = (second + prior_rows * second_all / n_all) / (n + prior_rows) - np.outer(mean, mean)
        out[lang] = mean, np.linalg.inv(cov + np.diag(np.maximum(floor - cov.diagonal(), floor * 1e-3)))
    return out


def outlierness(stats: DataFrame, model: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """stats with distance, the squared Mahalanobis distance from the language's prose, and c_<statistic>, what each
    statistic adds to it: its deviation times that of the whole, weighted by the inverse covariance."""

    def row(values: list[float]) -> Column:
        return F.array(*(F.lit(float(v)) for v in values))

    def by_language(pick: Callable[[tuple[np.ndarray, np.ndarray]], Column], kind: str) -> Column:
        out = F.lit(None).cast(kind)
        for lang, m in sorted(model.items()):
            out = F.when(F.col("language") == lang, pick(m)).otherwise(out)
        return out

    x = F.array(*(F.col(s) for s in STATISTICS))
    off = stats.withColumn("off", F.zip_with(x, by_language(lambda m: row(m[0]), "array<double>"), lambda a, b: a - b))
    off = off.withColumn("weights", by_language(lambda m: F.array(*(row(r) for r in m[1])), "array<array<double>>"))
    lean = F.transform("weights", lambda w: F.aggregate(F.zip_with(w, F.col("off"), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))

    def parts(c: Column) -> Column:
        total = F.aggregate(c, F.lit(0.0), lambda s, v: s + v)
        return F.struct(total.alias("distance"), *(c[i].alias(f"c_{s}") for i, s in enumerate(STATISTICS)))

    # a generator, as a filter on what comes out of a projection would be pushed below it and work all of it out again
    return off.select(*stats.columns, F.inline(F.transform(F.array(F.zip_with(F.col("off"), lean, lambda a, b: a * b)), parts)))


def kind_of_outlier() -> Column:
    """The kind whose statistics contribute most to the distance, negative contributions aside; prose if none of them
    does. Ties go to list, table, junk in this order."""
    sums = [F.struct(sum((F.greatest(F.col(f"c_{s}"), F.lit(0.0)) for s in names), F.lit(0.0)).alias("much"), F.lit(-i).alias("first"), F.lit(kind).alias("kind")) for i, (kind, names) in enumerate(SPEAKS_FOR.items())]
    best = F.greatest(*sums)
    return F.when(best["much"] > 0, best["kind"]).otherwise("prose")


def text_quality(documents: DataFrame, common_words: DataFrame, cutoff: float = 36.1) -> DataFrame:
    """Every document with its statistics, distance, contributions and kind.

    A document no further from the prose of its language than the cutoff (the 0.999 quantile of the chi-squared
    distribution with one degree per statistic) is prose; the kind of one further away is that whose statistics
    contribute most to the distance.
    """
    stats = cut(statistics(documents, common_words))
    far = outlierness(stats, prose_model(stats))
    return far.withColumn("kind", F.when(F.col("distance") > cutoff, kind_of_outlier()).otherwise("prose"))
