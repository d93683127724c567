from __future__ import annotations

import pytest

from foliograph.llm import markup as M

PLAIN = [
    "Tax = 27% x (£12,855 - £364) = £2,129.", "Enter the code trader_id in field 5_6 of the screen.", "Compare Example #4 [2019] and note * below.", "R&D costs and P&L entries of £19,483 are kept apart.",
    "Save the file under S:\\claims\\year17 and tell the officer.", "Either/or tests: <8 days, or >=77 days.", "No income is due if income < 1,771 and gains > 0.", "Step 1 => Step 2 -> statement (see note {4}).",
    "The sum of US$ 315 (A$ 683) was paid.", "The ratio 5*4/2 gives 17; the 'apparent' rate isn't used.", "- item\n* item\n1. item", "Year | Rate | Limit\n2019 | 28% | £9", "", "a\n\nb",
]


@pytest.mark.parametrize("text", PLAIN)
def test_plain(text):
    assert M.clean_text(text) == (text, [])


@pytest.mark.parametrize(("text", "kinds", "clean"), [
    ("a <b>b</b> c", ["html"], "a b c"), ("x&nbsp;y &amp; z", ["html"], "x y & z"), ("&lt;h2&gt;T&lt;/h2&gt;", ["html"], "T"), ("a <!-- n --> b", ["html"], "a b"), ("income < 5 <br/>and", ["html"], "income < 5\nand"),
    ("<ol><li>x</li><li>y</li>\n\nAfter that", ["html"], "1. x\n2. y\n\nAfter that"), ("<ul><li>x<li>y</ul>", ["html"], "- x\n- y"), ("<table><tr><td>a</td><td>b</td></tr></table>", ["html"], "a | b"),
    ("## T\n\n**b** and `c` [l](/u) ~~s~~", ["markdown"], "T\n\nb and c l s"), ("```\nnet = a - b\n```", ["markdown"], "net = a - b"), ("> q", ["markdown"], "q"), ("| a | b |\n|---|---|\n| 1 | 2 |", ["markdown"], "a | b\n1 | 2"),
    ("+ x\n- [ ] y", ["markdown"], "- x\n- y"), ("T\n====\nx[^1] [a][2]", ["markdown"], "T\n\nx a"),
    ("== T ==\n'''b''' [[P|l]] {{term|t}} {{cite|6}}", ["wiki"], "T\n\nb l t"), ("{| class=\"x\"\n! A !! B\n|-\n| 1 || 2\n|}", ["wiki"], "A | B\n1 | 2"), ("# [[x]]\n*'''y'''", ["wiki"], "- x\n- y"), ("[https://a.b l] __NOTOC__", ["wiki"], "l"),
    ("\\section{T}\n\\emph{e} $x_{1} \\leq 2$ \\pounds 808", ["latex"], "T\n\ne x_{1} \\leq 2 £808"), ("\\begin{itemize}\n\\item a\n\\end{itemize}", ["latex"], "- a"), ("\\begin{tabular}{ll}\nA & B \\\\\n1 & 3\\%\n\\end{tabular}", ["latex"], "A | B\n1 | 3%"),
    ("the\\footnote{n} x~\\ref{a}", ["latex"], "the (n) x"), ("<b>x</b> [[y]]", ["html", "wiki"], "x y"),
])
def test_residue(text, kinds, clean):
    assert M.clean_text(text) == (clean, kinds)


def test_density_drops_link_furniture_only():
    body = "".join(f"<p>{'Sentence of the guidance, quite long enough to be read. ' * 3}</p>" for _ in range(4))
    page = f"<div><ul>{''.join(f'<li><a href=/{i}>Link {i}</a></li>' for i in range(9))}</ul></div><div>{body}</div><p>Short but said.</p>"
    text, kinds = M.clean_text(page)
    assert kinds == ["html"] and "Link 3" not in text and text.count("Sentence") == 12 and "Short but said." in text


def test_long_and_unclosed():
    text = "<p>" * 2000 + "word " * 50_000
    assert M.clean_text(text)[0].count("word") == 50_000


def test_rows(spark):
    df = spark.createDataFrame([(1, "a <b>b</b>", "k"), (2, "plain", "k"), (3, None, "k"), (4, "", "k"), (1, "a <b>b</b>", "k")], "page_id bigint, text string, kinds string")
    got = sorted((r.page_id, r.clean, tuple(r.kinds)) for r in M.markup(df, "page_id").collect())
    assert got == [(1, "a b", ("html",)), (1, "a b", ("html",)), (2, "plain", ()), (4, "", ())]
    assert M.markup(df.limit(0), "page_id").count() == 0


PIECES = [*"<>`~\\\\{}[]$^&#;'*_=|!:-+()/.,%\n  x1", "---", ":---", "''", "**", "__", "==", "||", "| ", "\n", "a", "é", "TOC", "http://x", "&amp;", "<b>", "</b>", "\\frac", "{", "word", " ", "3", "[[", "]]", "1. ", "- "]


def test_no_residue_passes_the_trigger(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(3)
    texts = ["a | b\n:---|:---:\n1 | 2"] + ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14))) for _ in range(40_000)]
    plain = spark.createDataFrame([(t,) for t in texts], "t string").filter(~F.col("t").rlike(M.TRIGGER)).collect()
    assert len(plain) > 500
    assert [r.t for r in plain if M.kinds_of(r.t)] == []


def test_selection_is_counted_and_any_depth_is_the_same():
    body = "Sentence of the guidance, quite long enough to be read. " * 9
    nav = "".join(f"<a href=/{i}>Link {i}</a>" for i in range(9))
    text, _, (selected, beside, dropped) = M.cleaned(f"<nav>{nav}</nav><div><p>{body}</p><p>{body}</p></div><i>Beside.</i>")
    assert "Link" not in text and "Beside." in text and dropped == 9 * len("Link 1") and beside == len("Beside.") and selected >= 2 * len(body.strip())
    shallow = M.clean_text("<div><p>one</p><ul><li>two</li></ul></div>")[0]
    assert M.clean_text("<div>" * 3000 + "<p>one</p><ul><li>two</li></ul>" + "</div>" * 3000)[0] == shallow == "one\n\n- two"
    assert M.cleaned("no residue") == ("no residue", [], (10, 0, 0))
