from __future__ import annotations

import random

from foliograph.llm import leakage as L

ITEM = "The miller of Medtranfib spent 549 on reed baskets and 22 on a widowed clerk while Tybgrorvol Limited inherited some beehives many weeks later when the bank offered a better price for all of it."
OTHER = "Half the price went to a former partner and nothing else was lost in the yard at Trikwomwal where kiln bricks stood idle until the parish came to look at the ledger again."


def run(spark, docs, items=((1, ITEM, "Only the seller"), (2, OTHER, None), (3, None, "x"), (4, "", ""))):
    d = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id bigint, text string, item_id string")
    e = spark.createDataFrame([(*x, 0) for x in items], "item_id bigint, text string, answer string, doc_id int")
    return {(r.item_id, r.doc_id): r for r in L.find_leaks(d, e).collect()}


def test_whole_part_edited_and_not(spark):
    words = ITEM.split()
    edited = words[:8] + ["really"] + words[9:16] + words[17:]
    docs = [
        (1, f"Before. {ITEM} Only the seller."), (2, ITEM.upper().replace(" ", "\n ")), (3, " ".join(edited)), (4, "x " * 50 + " ".join(words[:14]) + " y" * 50), (5, " ".join(words[:9])),
        (6, None), (7, ""), (8, "!!!"), (9, f"{ITEM} {OTHER}"), (10, f"Before. {ITEM} Only the seller."), (11, " ".join(reversed(words))),
    ]
    got = run(spark, docs)
    assert set(got) == {(1, 1), (1, 2), (1, 3), (1, 4), (1, 9), (2, 9), (1, 10)}
    r = got[(1, 1)]
    assert r.share == 1 and docs[0][1][r.start : r.end] == ITEM.rstrip(".") and r.answer_follows
    assert not got[(1, 2)].answer_follows


def test_stretches_must_follow_the_item(spark):
    words = ITEM.split()
    a, b = words[:11], words[18:29]
    assert set(run(spark, [(1, " ".join(a + ["zzz"] * 9 + b)), (2, " ".join(a + ["zzz"] * 9 + words[:6]))])) == {(1, 1)}


def test_patterned_texts_do_not_count(spark):
    item = "On 21 August the yard at Sisfurthas was half finished and 654 wool packs stood idle for 12 weeks until 3 May when an uncle paid 817 towards 94 sail lofts."
    like = "On 17 November the yard at Pattitcog was half finished and 503 slate tiles stood idle for 40 weeks until 9 June when an aunt paid 331 towards 21 sail lofts."
    assert run(spark, [(1, like), (2, item)], [(5, item, "")]).keys() == {(5, 2)}


def test_short_items_blocks_and_empty(spark, monkeypatch):
    assert run(spark, []) == {} and run(spark, [(1, ITEM)], []) == {}
    monkeypatch.setattr(L, "BLOCK_CHARS", 10)
    assert set(run(spark, [(1, ITEM), (2, OTHER)])) == {(1, 1), (2, 2)}
    assert set(run(spark, [(1, "a tiny item here"), (2, "tiny")], [(9, "Tiny item", "")])) == {(9, 1)}


def test_random_edits(spark):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocab, k=60)), "") for i in range(20)]
    docs, want = [], set()
    for i, text, _ in items:
        words = text.split()
        at = rng.randrange(0, 30)
        cut = words[at : at + 30]
        for k in range(9, 30, 10):
            cut[k] = "changed"
        docs.append((i, " ".join(rng.choices(vocab, k=200) + cut + rng.choices(vocab, k=200))))
        want.add((i, i))
    assert set(run(spark, docs, items)) == want


def test_runs_shorter_than_a_window_count(spark):
    words = [f"w{i}" for i in range(48)]
    held = words[10:16] + ["changed"] + words[17:22] + ["changed"] + words[23:28]  # runs of 6, 5 and 5: one window
    text = " ".join(["x"] * 20 + held + ["y"] * 20)
    assert set(run(spark, [(1, text)], [(1, " ".join(words), "")])) == {(1, 1)}


def test_stretches_of_short_items(spark):
    words = ITEM.split()[:24]
    docs = [(1, "before " + " ".join(words[5:14]) + " after"), (2, "before " + " ".join(words[5:12]) + " after"), (3, " ".join(words[:5]))]
    assert set(run(spark, docs, [(1, " ".join(words), "")])) == {(1, 1)}
    assert L.least_stretch(24, 1 / 3) == 8 and L.least_stretch(60, 1 / 3) == L.STRETCH and L.least_stretch(4, 1 / 3) == 4


def test_every_sixth_or_seventh_word_changed(spark):
    words = (ITEM + " " + OTHER).split()[:30]
    for step in (6, 7):
        changed = ["zzz" if i % step == step - 1 else w for i, w in enumerate(words)]
        assert set(run(spark, [(1, " ".join(changed))], [(1, " ".join(words), "")])) == {(1, 1)}, step


def test_items_in_several_automata(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_CHARS", 250)
    assert set(run(spark, [(9, f"{ITEM} {OTHER}")])) == {(1, 9), (2, 9)}


def test_too_many_items_are_an_error(spark):
    import pytest

    with pytest.raises(ValueError, match="characters of items"):
        L.find_leaks(spark.createDataFrame([(1, "x")], "doc_id bigint, text string"), spark.createDataFrame([(1, ITEM, "")], "item_id bigint, text string, answer string"), max_chars=100)
