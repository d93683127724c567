from __future__ import annotations

import math

import numpy as np
import pytest

from foliograph.llm import quality as Q

EN = "the of and to in a is that for it as was with be by on not or are this at from but have which were all there when who if has under each his its may".split()
COMMON = {"en": set(EN), "fr": set("le la les de du des et en un une il est que qui dans pour par sur au ne pas ce avec lorsque".split()), "cy": set("y yr a o i yn ar mae gan ei bod bydd os".split())}
SENTENCES = [
    "The officer may review the claim where the return is late.", "An allowance of £1,200 was accepted because the burden lies on the person who claims.", "It is for the lender to show that the goods have left the warehouse.",
    "Treat the levy as arising in the final return even though the premises were empty.", "Check the valuation against the charge shown in box 43 of the return.",
]
PROSE = " ".join(SENTENCES)
WRAPPED = "\n".join(PROSE[i : i + 60].strip() for i in range(0, len(PROSE), 60))
KINDS = [
    (PROSE, "prose"), (PROSE.upper(), "prose"), (WRAPPED, "prose"), ("; ".join(s.rstrip(".") for s in SENTENCES), "prose"), ("\n".join(SENTENCES), "prose"), ("- " + "\n- ".join(SENTENCES), "prose"),
    ("\n".join(f"{m} {a} notice for the {b}" for m, a, b in zip("-*•-–", ["formal", "short", "joint", "final", "signed"], ["levy", "duty", "relief", "credit", "charge"], strict=True)), "list"),
    ("\n".join(f"RGM{i}: Meaning of levy" for i in range(10010, 10022)), "list"), ("\n".join(["Levy", "Base Cost", "report", "Surcharge", "ledger extract"] * 3), "list"), (f"{SENTENCES[0][:-1]}:\n" + "\n".join(f"({c}) formal register" for c in "abcdefgh"), "list"),
    ("\n".join(f"{1990 + i} | £{i},100 | market value" for i in range(12)), "table"), ("\n".join(f"{i}\t£{i}00\tRGM{i}000\t" for i in range(10, 22)), "table"), ("Rate,Code,From\n" + "\n".join(f'"£{i},200",{i},{1990 + i}' for i in range(10, 22)), "table"),
    ("\n".join(f"{1990 + i}        £{i},100      market value" for i in range(12)), "table"),
    ("\n".join(["Home", "Menu", "Skip to main content", "Cookies"] * 4), "junk"), ("Home > Menu > Cookies > Search > Home", "junk"), ("\n".join([SENTENCES[1]] * 9), "junk"), (" ".join([SENTENCES[1]] * 9), "junk"), ("", "junk"), (None, "junk"), ("...", "junk"), ("\n\n", "junk"),
    ("0~264!+~=4&0&\\?#%34\\<21<9^!#$~ \\**>\n17/|@\\|12\n+\\0+?/9$!74", "junk"), ('[{"id": 1, "k": "a", "v": [1, 2]}, {"id": 2, "k": "b", "v": [3]}]', "junk"), (".c9{margin:0px;color:#a0f402;}\n.c62{margin:3px;color:#0cc2da;}", "junk"),
    ("\n".join(f"2024-01-27T08:18:0{i}Z WARN worker-{i} id=d87964 status=40{i}" for i in range(9)), "junk"), ("K5CwHXjFFyQYkFYRLDKy9PUwNW8WIXUGYJ2WAtWA66dI\niqTwl2x8020MjCHbA4F0OlSvJzndjA3C6hlxRITV0aFN", "junk"),
    ("o,e b.lo£'i°0 §harge ~0 found `l t~~§0| `§2: |.|^ th0 ex¬¬ss c|ntr^.ut,¬£ o' t,o bl|.|cing da¬e", "junk"), ("drd jpwsm zpbx fmjcdzfp lpmjxpnx gqgkgmc qzfrbx wbl bqnjl ttwldz wg khlcflr tcvhctx pcprrlj", "junk"),
]


@pytest.mark.parametrize(("text", "kind"), KINDS)
def test_forms_of_lines_cover_the_text(text, kind):
    _, stats = Q.Reader(COMMON).measure(text or "")
    s = dict(zip(Q.STATISTICS, stats, strict=True))
    assert all(math.isfinite(x) for x in stats)
    assert abs(sum(s[f] for f in ("running", "brief", "marked", "celled", "controls", "bare")) - (s["symbols"] < 1)) < 1e-9


def test_statistics_and_language():
    reader = Q.Reader(COMMON)
    lang, stats = reader.measure("The cat sat on the mat.\nIt was £5 #")
    s = dict(zip(Q.STATISTICS, stats, strict=True))
    assert lang == "en" and s["common_words"] == 5 / 8 and s["end_marks"] == 0.5 and s["digits"] == 1 / 26 and s["symbols"] == 1 / 26
    assert s["word_length"] == 22 / 8 and abs(s["words_per_line"] - math.log1p(4)) < 1e-12
    assert reader.measure("Il est dans la maison et il ne parle pas.")[0] == "fr"


def test_memory_of_tokens_is_bounded():
    counts = Q._Tokens([frozenset(["a"])], most=10)
    assert [Q._lane(counts[f"x{i}"], Q._WORDS) for i in range(50)] == [1] * 50 and len(counts) <= 10


def frames(spark, texts):
    docs = spark.createDataFrame([(i, t, "xx", 0.0) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, distance double")
    words = spark.createDataFrame([(k, w, 1) for k, v in COMMON.items() for w in v] + [("en", None, 0)], "lang string, word string, word_rank int")
    return docs, words


PLAIN = [" ".join(SENTENCES[i % 5 :] + SENTENCES[: i % 5 + i % 3]) for i in range(120)]


def test_distance(spark):
    texts = PLAIN + [t for t, _ in KINDS]
    docs, words = frames(spark, texts)
    rows = sorted(Q.text_quality(docs, words).collect(), key=lambda r: r.doc_id)
    assert [(t, r.kind) for t, r in zip(texts, rows, strict=True)] == [(t, "prose") for t in PLAIN] + KINDS
    for r in rows:
        assert abs(sum(r[f"c_{s}"] for s in Q.STATISTICS) - r.distance) < 1e-6 * max(1, r.distance)
    stats = Q.statistics(docs, words)
    mean, inverse = Q.prose_model(stats)["en"]
    x = np.array([rows[130][s] for s in Q.STATISTICS]) - mean
    assert rows[130].language == "en" and abs(x @ inverse @ x - rows[130].distance) < 1e-6 * rows[130].distance


def test_the_distance_decides(spark):
    """Without the cutoff nearly every text has a kind; with a huge one none has."""
    docs, words = frames(spark, PLAIN + [t for t, _ in KINDS])
    count = lambda cutoff: Q.text_quality(docs, words, cutoff).filter("kind <> 'prose'").count()
    n = sum(1 for _, k in KINDS if k != "prose")
    assert count(0.0) > 2 * n and count(1e9) == 0


def test_larger_part(spark):
    """Mixed texts are of the kind of their larger part."""
    items = [f"- short notice {c}" for c in "abcdefghijklmnop"]
    table = [f"{1990 + i} | £{i},100 | {i}%" for i in range(12)]
    prose = SENTENCES * 2
    mixed = [("\n".join(prose + items[:6]), "prose"), ("\n".join(prose[:3] + items * 3), "list"), ("\n".join(prose + table[:4]), "prose"), ("\n".join(SENTENCES[:2] + table * 3), "table"), ("\n".join(table * 2 + items[:4]), "table"), ("\n".join(items * 3 + table[:3]), "list")]
    docs, words = frames(spark, PLAIN + [t for t, _ in mixed])
    rows = {r.doc_id: r.kind for r in Q.text_quality(docs, words).collect()}
    assert [rows[len(PLAIN) + i] for i in range(len(mixed))] == [k for _, k in mixed]


def test_a_rare_language_leans_on_the_others(spark):
    docs, words = frames(spark, PLAIN + ["Il est dans la maison et il ne parle pas avec les gens qui sont sur le pont."] * 3)
    rows = Q.text_quality(docs, words).collect()
    assert {r.language for r in rows} == {"en", "fr"} and {r.kind for r in rows} == {"prose"}


def test_empty(spark):
    docs, words = frames(spark, [])
    assert Q.text_quality(docs, words).count() == 0
    docs, words = frames(spark, ["only one text here", "only one text here"])
    assert Q.text_quality(docs, words.limit(0)).count() == 2
