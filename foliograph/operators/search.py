"""Search by meaning over sections and entities: one query vector, nearest vectors, and their neighbourhoods."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.operators import retrieval, vectors
from foliograph.operators.models import Embedder, embed_query

KINDS = ("sections", "entities")


def search(kind: str, query: str, tables: Mapping[str, DataFrame], embedder: Embedder | None = None, top: int = 5, snippet: int = 400, vector: list[float] | None = None) -> DataFrame:
    """The `top` sections or entities (1 to 10) nearest to a query, with their neighbourhoods, best first.

    tables holds `section_vectors` (node_id, embedding), `sections`, `mentions` and `entities`, or `entity_vectors`
    (key, embedding), `entities`, `discusses` and `edges`. The query is embedded unless its vector is given, so that one
    vector can serve both kinds.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    if vector is None:
        if embedder is None:
            raise ValueError("an embedder or a vector is needed")
        vector = embed_query(query, embedder)
    if kind == "sections":
        near = vectors.nearest(tables["section_vectors"], vector, vectors.clamp(top), "node_id").select(F.col("node_id").alias("id"), "score")
        out = retrieval.section_hits(near, tables["sections"], tables["mentions"], tables["entities"], snippet)
        return out.orderBy(F.desc("score"), "id")
    near = vectors.nearest(tables["entity_vectors"], vector, vectors.clamp(top), "key").select("key", "score")
    return retrieval.entity_hits(near, tables["entities"], tables["discusses"], tables["edges"], snippet).orderBy(F.desc("score"), "key")


def search_both(kind: str, query: str, tables: Mapping[str, DataFrame], embedder: Embedder, top: int = 5) -> dict[str, DataFrame]:
    """search for `sections`, `entities` or, with one embedding, `both`."""
    vector = embed_query(query, embedder)
    return {k: search(k, query, tables, top=top, vector=vector) for k in (KINDS if kind == "both" else (kind,))}
