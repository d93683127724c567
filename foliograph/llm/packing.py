"""Filling containers of fixed capacity with whole documents.

What is packed is the histogram of sizes, not the documents: a source of any size gives at most one row per size up
to the capacity, so the packing of one source is a bounded task. Documents then take the places the plan gives their
size.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A token is a longest run of letters, digits and underscores, or a longest run of other visible characters.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}\p{C}]+"


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN))


def tokenizer_count(path: str) -> Callable[[Column], Column]:
    """Counter of the tokens of a public byte-pair tokenizer, given the path of its JSON file, in place of the rule."""

    @F.pandas_udf("int")
    def count(text: pd.Series) -> pd.Series:
        from tokenizers import Tokenizer

        coder = Tokenizer.from_file(path)
        coder.encode_special_tokens = True
        return pd.Series([len(e.ids) for e in coder.encode_batch(text.fillna("").tolist(), add_special_tokens=False)])

    return count


# --------------------------------------------------------------------------- the packing of one histogram


class _Counts:
    """Sizes that are left, with how many of each."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: c for s, c in counts.items() if c > 0}
        self.sizes = sorted(self.n)

    def take(self, size: int, count: int) -> None:
        self.n[size] -= count
        if not self.n[size]:
            del self.n[size]
            del self.sizes[bisect_left(self.sizes, size)]

    def put(self, size: int, count: int) -> None:
        if size not in self.n:
            self.sizes.insert(bisect_left(self.sizes, size), size)
        self.n[size] = self.n.get(size, 0) + count

    def largest(self, limit: int) -> int | None:
        at = bisect_right(self.sizes, limit)
        return self.sizes[at - 1] if at else None

    def smallest(self, k: int, above: int = 0) -> list[int]:
        """The k smallest items larger than `above`, or as many as there are."""
        out: list[int] = []
        for s in self.sizes[bisect_right(self.sizes, above) :]:
            out += [s] * min(self.n[s], k - len(out))
            if len(out) == k:
                break
        return out

    def pair_fits(self, room: int, above: int = 0) -> bool:
        """Whether two items larger than `above` fit into the room together."""
        two = self.smallest(2, above)
        return len(two) == 2 and sum(two) <= room

    def best_pair_sum(self, room: int) -> int:
        """Greatest sum of two items that fits; 0 if no two do."""
        lo, hi, best = 0, len(self.sizes) - 1, 0
        while lo <= hi:
            a, b = self.sizes[lo], self.sizes[hi]
            if a + b > room:
                hi -= 1
            elif lo == hi:
                if self.n[a] > 1:
                    best = max(best, a + b)
                break
            else:
                best = max(best, a + b)
                lo += 1
        return best


Group = tuple[int, tuple[tuple[int, int], ...]]  # number of containers, (size, items of it) in each


def _companions(rest: _Counts, room: int) -> list[int] | None:
    """Companions of an item that leaves `room`, such that no other set of companions can beat them; None if there is
    no verdict. One set beats another if the other's items can be shared out among its own, none overfilled.

    Nothing fits: none. The largest companion that fits fills the room, or no two fit, or (where no three fit) no two
    together are larger than it: that one. No three fit, and no two that are both larger than the best partner of the
    largest companion: these two, as each feasible pair has an item no larger than the partner, and the other one is
    no larger than the largest.
    """
    first = rest.largest(room)
    if first is None:
        return []
    if first == room or not rest.pair_fits(room):
        return [first]
    three = rest.smallest(3)
    if len(three) == 3 and sum(three) <= room:
        return None
    if rest.best_pair_sum(room) <= first:
        return [first]
    rest.take(first, 1)
    second = rest.largest(room - first)
    rest.put(first, 1)
    if second is not None and not rest.pair_fits(room, above=second):
        return [first, second]
    return None


def reduce_by_dominance(left: _Counts, capacity: int) -> list[Group]:
    """Containers that some best packing has (Martello and Toth): sets of up to three items, one of them given, that
    no other set with that item can beat. They are fixed, for all copies of the sizes at once (fewer items left can't
    make another set better), until none is found."""
    fixed: list[Group] = []
    changed = True
    while changed and left.sizes:
        changed = False
        for a in list(reversed(left.sizes)):
            while left.n.get(a):
                left.take(a, 1)  # the item itself is no companion of its own
                with_it = _companions(left, capacity - a)
                left.put(a, 1)
                if with_it is None:
                    break
                content = [a, *with_it]
                need = {s: content.count(s) for s in content}
                times = min(left.n[s] // k for s, k in need.items())
                for s, k in need.items():
                    left.take(s, k * times)
                fixed.append((times, tuple(sorted(need.items(), reverse=True))))
                changed = True
    return fixed


def best_fit(left: _Counts, capacity: int) -> list[Group]:
    """Best-fit decreasing over counts: copies of a size fill like containers in one step.

    Containers with the same content are one group with a number. A size splits at most one group and opens at most
    two, so the groups stay fewer than three times the sizes, however many items there are.
    """
    groups: list[list] = []  # [containers, room, content]
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []

    def add(count: int, room: int, content: dict[int, int]) -> None:
        if not count:
            return
        groups.append([count, room, content])
        if room not in by_room:
            by_room[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        by_room[room].append(len(groups) - 1)

    for size in reversed(left.sizes):
        n = left.n[size]
        while n:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                whole, rest = divmod(n, each)
                add(whole, capacity - each * size, {size: each})
                add(1 if rest else 0, capacity - rest * size, {size: rest})
                break
            room = rooms[at]
            g = groups[by_room[room].pop()]
            if not by_room[room]:
                del by_room[room], rooms[at]
            each = room // size
            whole = min(g[0], n // each)
            rest = min(n - whole * each, each - 1) if whole < g[0] else 0
            count, content = g[0], g[2]
            g[0] = 0
            add(count - whole - (1 if rest else 0), room, content)
            add(whole, room - each * size, {**content, size: each})
            add(1 if rest else 0, room - rest * size, {**content, size: rest})
            n -= whole * each + rest
    return [(g[0], tuple(sorted(g[2].items(), reverse=True))) for g in groups if g[0]]


def pack_counts(counts: dict[int, int], capacity: int) -> list[Group]:
    """Groups of containers for the sizes given. Items of size 0 go to the first container."""
    empty = counts.get(0, 0)
    left = _Counts({s: c for s, c in counts.items() if s > 0})
    groups = reduce_by_dominance(left, capacity)
    groups += best_fit(left, capacity)
    if empty:
        first, rest = (groups[0], groups[1:]) if groups else ((1, ()), [])
        groups = [(1, (*first[1], (0, empty)))] + ([(first[0] - 1, first[1])] if first[0] > 1 else []) + rest
    return groups


def least_containers(sizes: Iterable[tuple[int, int]], capacity: int) -> int:
    """Lower bound of the number of containers: the total size, or the items over half the capacity (bound L2)."""
    rows = sorted((s, c) for s, c in sizes if s > 0)
    best = -(-sum(s * c for s, c in rows) // capacity)
    for k in {0, *(s for s, _ in rows if 2 * s <= capacity)}:
        big = sum(c for s, c in rows if s > capacity - k)
        mid = [(s, c) for s, c in rows if capacity - k >= s and 2 * s > capacity]
        low = sum(s * c for s, c in rows if k <= s and 2 * s <= capacity)
        n_mid = sum(c for _, c in mid)
        room = n_mid * capacity - sum(s * c for s, c in mid)
        best = max(best, big + n_mid + max(0, -(-(low - room) // capacity)))
    return best


# --------------------------------------------------------------------------- plan

ITEM = ["budget_id", "source", "size"]


def _pieces(documents: DataFrame, budgets: list[tuple[int, int]], size: Column) -> DataFrame:
    """One row per budget and piece: (budget_id, source, doc_id, piece_no, token_start, size). Only a document larger
    than the capacity has several: full ones, and what is left."""
    caps = F.array(*(F.struct(F.lit(b).alias("budget_id"), F.lit(c).alias("capacity")) for b, c in budgets))
    rows = documents.select(F.coalesce("source", F.lit("")).alias("source"), "doc_id", F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("int").alias("total"), F.explode(caps).alias("b"))
    rows = rows.select("source", "doc_id", "total", "b.budget_id", "b.capacity")
    last = F.greatest(F.ceil(F.col("total") / F.col("capacity")).cast("int"), F.lit(1)) - 1
    rows = rows.withColumn("piece_no", F.explode(F.sequence(F.lit(0), last)))
    start = (F.col("piece_no") * F.col("capacity")).cast("int")
    return rows.select("budget_id", "source", "doc_id", "piece_no", start.alias("token_start"), F.least(F.col("total") - start, F.col("capacity")).cast("int").alias("size"))


def _ranked(pieces: DataFrame, salts: int) -> DataFrame:
    """pieces with place: their number, from 0, among those of the same budget, source and size.

    Numbers run within salted parts of such a group, each with the count of the parts before it added, so that a hot
    source or size is spread over `salts` tasks.
    """
    from pyspark.sql import Window as W

    rows = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(salts)).cast("int"))
    counts = rows.groupBy(*ITEM, "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy(*ITEM).orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*ITEM, "salt", before.alias("before"))
    number = F.row_number().over(W.partitionBy(*ITEM, "salt").orderBy("doc_id", "piece_no")) - 1
    return rows.withColumn("number", number).join(counts, [*ITEM, "salt"]).withColumn("place", F.col("number") + F.col("before")).drop("salt", "number", "before")


PLAN = "budget_id int, source string, size int, first_place bigint, first_container bigint, containers bigint, each int"


def _plans(counts: DataFrame, budgets: list[tuple[int, int]]) -> DataFrame:
    capacity = dict(budgets)

    def plan(hist: pd.DataFrame) -> pd.DataFrame:
        budget, source = int(hist["budget_id"].iloc[0]), hist["source"].iloc[0]
        groups = pack_counts(dict(zip(hist["size"].tolist(), hist["n"].tolist(), strict=True)), capacity[budget])
        rows, container, used = [], 0, {}
        for n, content in groups:
            for size, each in content:
                rows.append((budget, source, size, used.get(size, 0), container, n, each))
                used[size] = used.get(size, 0) + n * each
            container += n
        return pd.DataFrame(rows, columns=[c.split()[0] for c in PLAN.split(", ")])

    return counts.groupBy("budget_id", "source").applyInPandas(plan, PLAN)


def _slots(plans: DataFrame, chunk: int) -> DataFrame:
    """(budget_id, source, size, place, container_no), one row per place. Long runs are cut into chunks and spread
    before the places are written out."""
    total = F.col("containers") * F.col("each")
    parts = plans.withColumn("from", F.explode(F.sequence(F.lit(0).cast("bigint"), total - 1, F.lit(chunk).cast("bigint"))))
    parts = parts.withColumn("k", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + chunk, total) - 1)))
    return parts.select(*ITEM, (F.col("first_place") + F.col("k")).alias("place"), (F.col("first_container") + F.floor(F.col("k") / F.col("each"))).alias("container_no"))


def pack(documents: DataFrame, budgets: DataFrame, size: Column | None = None, salts: int = 64, chunk: int = 100_000) -> DataFrame:
    """(budget_id, source, container_no, doc_id, piece_no, token_start, n_tokens): every document of every source once
    for each capacity, whole, or in pieces if it alone exceeds it. No container exceeds its capacity.

    Sets that dominance proves best are fixed, the rest is packed best fit, both on counts of sizes. Sizes are
    n_tokens where given, else counted from the text (or given as `size`); null text has size 0. Documents of size 0
    are placed like others. A null source is the source ''. Budgets are a few rows: more than 1,000, null or not
    positive ones are errors. Repeated rows are packed each; an empty table gives an empty result.
    """
    caps = [(r[0], r[1]) for r in budgets.select("budget_id", "capacity_tokens").distinct().orderBy("budget_id").limit(1001).collect()]
    if len(caps) > 1000 or len({b for b, _ in caps}) < len(caps) or any(b is None or c is None or c < 1 for b, c in caps):
        raise ValueError("budgets must be at most 1,000 distinct positive capacities")
    if size is None:
        size = F.coalesce(F.col("n_tokens"), token_count(F.col("text")))
    pieces = _pieces(documents, caps, size)
    counts = pieces.groupBy(*ITEM).agg(F.count(F.lit(1)).alias("n"))
    slots = _slots(_plans(counts, caps), chunk)
    placed = _ranked(pieces, salts).join(slots, [*ITEM, "place"])
    return placed.select("budget_id", "source", "container_no", "doc_id", "piece_no", "token_start", F.col("size").alias("n_tokens"))


def fill(packed: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per budget and source: containers, the least number any packing needs, tokens, and the share of room used."""
    caps = {r[0]: r[1] for r in budgets.select("budget_id", "capacity_tokens").collect()}
    sizes = packed.groupBy("budget_id", "source", F.col("n_tokens").alias("size")).agg(F.count(F.lit(1)).alias("n"))

    def bound(hist: pd.DataFrame) -> pd.DataFrame:
        budget = int(hist["budget_id"].iloc[0])
        least = least_containers(zip(hist["size"].tolist(), hist["n"].tolist(), strict=True), caps[budget])
        return pd.DataFrame({"budget_id": [budget], "source": [hist["source"].iloc[0]], "least": [least]})

    least = sizes.groupBy("budget_id", "source").applyInPandas(bound, "budget_id int, source string, least bigint")
    used = packed.groupBy("budget_id", "source", "container_no").agg(F.sum("n_tokens").alias("t")).groupBy("budget_id", "source").agg(F.count(F.lit(1)).alias("containers"), F.sum("t").alias("tokens"))
    room = F.element_at(F.create_map(*(F.lit(x) for kv in caps.items() for x in kv)), F.col("budget_id"))
    return used.join(least, ["budget_id", "source"]).select("budget_id", "source", "containers", "least", "tokens", F.round(F.col("tokens") / (F.col("containers") * room), 4).alias("filled"))
