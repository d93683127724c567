"""Joins on keys of which one may hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.session import cut

#: A key is heavy if it has at least this share of the rows, so there are at most a thousand of them at any size.
HEAVY_SHARE = 0.001
#: Rows that a single task joins without trouble whatever their keys; tables up to this are joined plainly. The rows
#: that come out are the same.
SMALL_ROWS = 200_000


def is_small(rows: DataFrame, n: int | None = None) -> bool:
    """Whether a table, of n rows if that is known, has at most SMALL_ROWS."""
    return (rows.count() if n is None else n) <= SMALL_ROWS


def heavy_keys(rows: DataFrame, on: list[str], share: float = HEAVY_SHARE) -> DataFrame:
    """The keys with at least `share` of the rows: at most 1/share of them. The rows are counted per key before they are
    shuffled, so that a key with any number of rows moves one row a partition."""
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    total = rows.agg(F.count(F.lit(1))).scalar()
    return cut(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= total * share).select(*on))


class Split:
    """Rows parted into those with heavy keys and the others, for joins on that key, once or in every round of a loop.

    What is joined must have at most one row a key. Of it the rows of heavy keys are broadcast, at most 1/share of
    them; the others meet the rest of the rows in a shuffle join, where no key has more than `share` of all rows. So no
    task gets a hot key's rows, whether or not the session handles skew.
    """

    def __init__(self, rows: DataFrame, on: list[str], share: float = HEAVY_SHARE, like: Split | None = None, n: int | None = None):
        self.on = on
        self.heavy = like.heavy if like is not None else None if is_small(rows, n) else heavy_keys(rows, on, share)
        self.hot, self.cold = None, rows
        if self.heavy is not None:
            self.hot = rows.join(F.broadcast(self.heavy), on, "left_semi")
            self.cold = rows.join(F.broadcast(self.heavy), on, "left_anti")

    def kept(self) -> Split:
        """The same with both parts materialised, for a loop."""
        self.hot, self.cold = None if self.hot is None else cut(self.hot), cut(self.cold)
        return self

    def join(self, other: DataFrame, how: str = "inner") -> DataFrame:
        """Rows joined with `other` (inner, left, left_semi or left_anti), as one DataFrame."""
        cold = self.cold.join(other, self.on, how)
        if self.hot is None:
            return cold
        few = other.join(F.broadcast(self.heavy), self.on, "left_semi")
        return self.hot.join(F.broadcast(few), self.on, how).unionByName(cold)


def split_join(rows: DataFrame, other: DataFrame, on: str | list[str], how: str = "inner", share: float = HEAVY_SHARE, n: int | None = None) -> DataFrame:
    """rows joined with `other`, which has at most one row a key, without a task for a hot key; see Split."""
    return Split(rows, [on] if isinstance(on, str) else on, share, n=n).join(other, how)


def grid_join(a: DataFrame, b: DataFrame, on: list[str], share: float = HEAVY_SHARE, side: int = 8, n: int | None = None) -> DataFrame:
    """Inner join of two tables that may both have many rows a key. Keys that are heavy in either are cut into `side`
    parts on both sides, and every part meets every part under a key of its own, so that no task gets more than a
    side-th of a hot key's rows of either table. n is the number of rows of the larger one, if it is known."""
    if is_small(a, n) and is_small(b, n):
        return a.join(b, on)
    heavy = cut(heavy_keys(a, on, share).union(heavy_keys(b, on, share)).distinct())
    parts = F.array(*map(F.lit, range(side)))

    def cell(df: DataFrame, own: str, other: str) -> DataFrame:
        rest = [c for c in df.columns if c not in on]
        hot = df.join(F.broadcast(heavy), on, "left_semi")
        return hot.select(*on, *rest, F.pmod(F.xxhash64(*rest), F.lit(side)).cast("int").alias(own), F.explode(parts).alias(other))

    hot = cell(a, "_x", "_y").join(cell(b, "_y", "_x"), [*on, "_x", "_y"]).drop("_x", "_y")
    cold = a.join(F.broadcast(heavy), on, "left_anti").join(b, on)
    return hot.unionByName(cold)
