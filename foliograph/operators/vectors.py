"""Exact and inverted-file nearest-neighbour search by cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null if one is null, of another length or zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(F.size(a) == F.size(b), dot(a, b) / F.nullif(norms, F.lit(0.0)))


def clamp(k: int, most: int = 10) -> int:
    """Size of a result asked for, between 1 and the most allowed."""
    return max(1, min(most, int(k)))


def nearest(vectors: DataFrame, query: list[float], k: int, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, score) of the k vectors nearest to one, by cosine, ties by id. One narrow pass and a top-k."""
    q = F.array(*(F.lit(float(x)) for x in query))
    scored = vectors.select(F.col(id_column), cosine(F.col(column), q).alias("score")).filter("score is not null")
    return scored.orderBy(F.desc("score"), F.col(id_column)).limit(k)


def _matrix(rows: pd.Series, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of a block, and which rows have one."""
    ok = np.array([r is not None and len(r) == dims for r in rows], dtype=bool)
    m = np.zeros((len(rows), dims))
    for i in np.flatnonzero(ok):
        m[i] = rows.iloc[i]
    norm = np.linalg.norm(m, axis=1)
    ok &= norm > 0
    m[ok] /= norm[ok, None]
    return m, ok


def nearest_of_each(vectors: DataFrame, queries: DataFrame, k: int, dims: int, id_column: str = "vec_id", column: str = "embedding", block_rows: int = 20_000, total_rows: int | None = None) -> DataFrame:
    """(query_id, id, score, rank): the k nearest of every query vector among all vectors but itself, exactly.

    Both sides are cut into blocks by hash, and every pair of blocks meets in a task of its own as two matrices, which
    gives its k best per query; a window keeps the best of those. Nothing is broadcast and no task sees more than two
    blocks. Null, zero and odd-sized vectors have no neighbours and are none. Ties go to the smaller id.
    """
    n = total_rows or vectors.count()
    m = queries.count()
    left, right = max(1, -(-m // block_rows)), max(1, -(-n // block_rows))
    vid = dict(vectors.dtypes)[id_column]
    q = queries.select(F.col(id_column).alias("id"), F.col(column).alias("v"), F.pmod(F.xxhash64(id_column), F.lit(left)).cast("int").alias("a")).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(right - 1))))
    x = vectors.select(F.col(id_column).alias("id"), F.col(column).alias("v"), F.pmod(F.xxhash64(id_column), F.lit(right)).cast("int").alias("b")).withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(left - 1))))

    def meet(qs: pd.DataFrame, xs: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(qs) and len(xs):
            xs = xs.sort_values("id", kind="stable").reset_index(drop=True)
            qm, q_ok = _matrix(qs["v"], dims)
            xm, x_ok = _matrix(xs["v"], dims)
            xid = xs["id"].to_numpy()
            for at in range(0, len(qs), 1024):
                scores = np.round(qm[at : at + 1024] @ xm.T, 12)
                scores[:, ~x_ok] = -np.inf
                ids = qs["id"].to_numpy()[at : at + 1024]
                scores[ids[:, None] == xid[None, :]] = -np.inf
                best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                for r in np.flatnonzero(q_ok[at : at + 1024]):
                    keep = best[r][np.isfinite(scores[r, best[r]])]
                    out.append(pd.DataFrame({"query_id": ids[r], "id": xid[keep], "score": scores[r, keep]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    partial = q.groupBy("a", "b").cogroup(x.groupBy("a", "b")).applyInPandas(meet, f"query_id {vid}, id {vid}, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return partial.withColumn("rank", rank).filter(F.col("rank") <= k)


#: Fewer cells than this aren't worth an index; share of neighbours that the cells looked into must hold in the sample.
MIN_CELLS, RECALL = 32, 0.95


class InvertedFile:
    """Index of cells around centroids. The centroids are fitted on a bounded sample; every vector is indexed.

    `sample_rows` bounds the fit. Without `cells` there are as many as the root of the number of vectors (MIN_CELLS at
    least, a tenth of the sample at most), so that a cell grows with the root too. Recall is measured against the exact
    search in the tests and by o72_recall, see `search`.
    """

    def __init__(self, cells: int | None = None, sample_rows: int = 20_000, iterations: int = 15, seed: int = 7):
        self.cells, self.sample_rows, self.iterations, self.seed = cells, sample_rows, iterations, seed
        self.centroids, self.probes = np.zeros((0, 0)), 1

    def fit(self, vectors: DataFrame, column: str = "embedding") -> InvertedFile:
        rows = vectors.filter(F.col(column).isNotNull()).orderBy(F.xxhash64(column, F.lit(self.seed))).limit(self.sample_rows).select(column).toPandas()[column]
        if not len(rows):
            return self
        data, ok = _matrix(rows, len(rows.iloc[0]))
        data = data[ok]
        if self.cells is None:
            self.cells = max(MIN_CELLS, min(round(vectors.count() ** 0.5), self.sample_rows // 10))
        rng = np.random.default_rng(self.seed)
        at = data[rng.choice(len(data), size=min(self.cells, len(data)), replace=False)]
        for _ in range(self.iterations):
            own = np.argmax(data @ at.T, axis=1)
            new = np.array([data[own == c].mean(axis=0) if np.any(own == c) else at[c] for c in range(len(at))])
            at = new / np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        self.centroids = at
        self.probes = self._probes(data)
        return self

    def _probes(self, data: np.ndarray) -> int:
        """The least number of cells to look into for RECALL of the ten nearest of a hundred rows of the sample."""
        asked = data[:: max(1, len(data) // 100)]
        scores = asked @ data.T
        np.put_along_axis(scores, np.argmax(scores, axis=1)[:, None], -np.inf, axis=1)  # itself
        near = np.argsort(-scores, axis=1, kind="stable")[:, : min(10, max(1, len(data) - 1))]
        own = np.argmax(data @ self.centroids.T, axis=1)
        place = np.argsort(np.argsort(-(asked @ self.centroids.T), axis=1, kind="stable"), axis=1)
        needed = np.take_along_axis(place, own[near], axis=1).ravel()
        return int(np.quantile(needed, RECALL, method="higher")) + 1 if len(needed) else 1

    def assign(self, vectors: DataFrame, probes: int, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
        """(id, v, cell): every vector with its nearest `probes` cells."""
        kind = dict(vectors.dtypes)[id_column]
        centroids = self.centroids

        def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                m, ok = _matrix(batch["v"], centroids.shape[1])
                best = np.argsort(-(m @ centroids.T), axis=1, kind="stable")[:, :probes]
                rows = np.repeat(np.flatnonzero(ok), best.shape[1])
                yield pd.DataFrame({"id": batch["id"].to_numpy()[rows], "v": batch["v"].to_numpy()[rows], "cell": best[ok].ravel().astype("int32")})

        return vectors.select(F.col(id_column).alias("id"), F.col(column).alias("v")).mapInPandas(cells, f"id {kind}, v array<float>, cell int")

    def search(self, vectors: DataFrame, queries: DataFrame, k: int, probes: int | None = None, id_column: str = "vec_id", column: str = "embedding", salts: int = 16) -> DataFrame:
        """(query_id, id, score, rank) from the cells nearest to each query, by default as many as the sample needed for
        RECALL. The vectors of a cell are spread over `salts` tasks, and each query
        goes to all of them, so that a hot cell is no hot task."""
        probes = probes or self.probes
        own = self.assign(vectors, 1, id_column, column).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
        asked = self.assign(queries, probes, id_column, column).select(F.col("id").alias("query_id"), F.col("v").alias("q"), "cell", F.explode(F.array(*map(F.lit, range(salts)))).alias("salt"))
        hits = asked.join(own, ["cell", "salt"]).filter("id <> query_id").select("query_id", "id", F.round(cosine(F.col("q"), F.col("v")), 12).alias("score")).filter("score is not null")
        return hits.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))).filter(F.col("rank") <= k)
