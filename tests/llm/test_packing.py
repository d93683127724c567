from __future__ import annotations

import random

import pytest

from foliograph.llm import packing as P


def flat(groups):
    return sorted(s for n, content in groups for s, k in content for _ in range(n * k))


def optimum(sizes, capacity):
    best = [len(sizes)]
    sizes = sorted(sizes, reverse=True)

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        tried = set()
        for b in range(len(bins)):
            if bins[b] >= sizes[i] and bins[b] not in tried:
                tried.add(bins[b])
                bins[b] -= sizes[i]
                go(i + 1, bins)
                bins[b] += sizes[i]
        bins.append(capacity - sizes[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(10))
def test_dominance_keeps_an_optimum(seed):
    rng = random.Random(seed)
    for _ in range(500):
        cap = rng.randint(5, 40)
        sizes = [rng.randint(1, cap) for _ in range(rng.randint(1, 9))]
        counts = {s: sizes.count(s) for s in sizes}
        groups = P.pack_counts(counts, cap)
        best = optimum(sizes, cap)
        assert flat(groups) == sorted(sizes) and all(sum(s * k for s, k in c) <= cap for _, c in groups)
        assert P.least_containers(counts.items(), cap) <= best
        left = P._Counts(counts)
        fixed = P.reduce_by_dominance(left, cap)
        rest = [s for s, c in left.n.items() for _ in range(c)]
        assert sum(n for n, _ in fixed) + (optimum(rest, cap) if rest else 0) == best


def test_a_full_trio_is_not_always_best():
    sizes = [17, 12, 12, 11, 10, 10, 7, 6]
    left = P._Counts({s: sizes.count(s) for s in sizes})
    fixed = P.reduce_by_dominance(left, 30)
    rest = [s for s, c in left.n.items() for _ in range(c)]
    assert sum(n for n, _ in fixed) + (optimum(rest, 30) if rest else 0) == 3 == optimum(sizes, 30)


def test_best_pair():
    rng = random.Random(1)
    for _ in range(500):
        items = [rng.randint(1, 12) for _ in range(rng.randint(1, 7))]
        room = rng.randint(1, 25)
        left = P._Counts({s: items.count(s) for s in items})
        want = max((a + b for i, a in enumerate(items) for b in items[:i] if a + b <= room), default=0)
        assert left.best_pair_sum(room) == want and left.pair_fits(room) == (want > 0)


def test_work_depends_on_sizes_not_items():
    groups = P.pack_counts({s: 10**9 + s for s in range(0, 513)}, 512)
    assert len(groups) < 3 * 513 and sum(n * dict(c).get(7, 0) for n, c in groups) == 10**9 + 7


def pack(spark, docs, caps, **kw):
    d = spark.createDataFrame([(i, s, n, t, "clash") for i, s, n, t in docs], "doc_id bigint, source string, n_tokens int, text string, size string")
    b = spark.createDataFrame([(i, c) for i, c in enumerate(caps)], "budget_id int, capacity_tokens int")
    return P.pack(d, b, **kw)


@pytest.mark.parametrize("salts", [1, 8])
def test_places(spark, salts):
    rng = random.Random(2)
    docs = [(i, rng.choice(["a", "a", "b", None]), rng.choice([None, rng.randint(0, 60), 40]), "w, x " * rng.randint(0, 90)) for i in range(400)]
    size = {i: n if n is not None else len([c for w in t.split() for c in (w.rstrip(","), *([","] if w.endswith(",") else []))]) for i, _, n, t in docs}
    got = pack(spark, docs, [50, 100], salts=salts, chunk=7).collect()
    room = {}
    for budget, cap in ((0, 50), (1, 100)):
        mine = [r for r in got if r.budget_id == budget]
        per = {}
        for r in mine:
            per.setdefault(r.doc_id, []).append(r)
            key = (budget, r.source, r.container_no)
            room[key] = room.get(key, 0) + r.n_tokens
            assert room[key] <= cap
        assert set(per) == set(size)
        for i, pieces in per.items():
            pieces.sort(key=lambda r: r.piece_no)
            assert sum(r.n_tokens for r in pieces) == size[i] and len(pieces) == max(1, -(-size[i] // cap))
            assert [r.token_start for r in pieces] == [k * cap for k in range(len(pieces))]


def test_edges(spark):
    assert pack(spark, [], [10]).count() == 0
    assert [(r.container_no, r.n_tokens) for r in pack(spark, [(1, "a", None, None), (2, "a", None, "")], [10]).collect()] == [(0, 0), (0, 0)]
    assert sorted((r.container_no, r.n_tokens) for r in pack(spark, [(1, "a", 5, ""), (1, "a", 5, "")], [5]).collect()) == [(0, 5), (1, 5)]
    for caps in ([0], [None]):
        with pytest.raises(ValueError):
            pack(spark, [], caps)


def test_public_tokenizer_counts(spark):
    import os

    path = "/opt/tokenizers/byte_bpe_50k.json"
    if not os.path.exists(path):
        pytest.skip("no tokenizer")
    df = spark.createDataFrame([("hello world",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(P.tokenizer_count(path)(df["t"])).collect()] == [2, 0, 0]
