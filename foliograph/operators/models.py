"""External models behind small interfaces: extraction and embedding, with caches and failures as data."""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol, TypeVar

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.functions import text as T
from foliograph.operators.chunking import cache_split
from foliograph.sources.crawl import retryable

T_ = TypeVar("T_")


class TruncatedResponse(RuntimeError):
    """The answer ended before it was complete; the chunk is to be halved."""


class FatalError(RuntimeError):
    """An error no retry mends."""


class ProviderError(RuntimeError):
    """An answer of a model's service with a status other than success."""

    def __init__(self, status: int, message: str = ""):
        super().__init__(f"status {status} {message}".strip())
        self.status = status


def attempted(call: Callable[[], T_], attempts: int, sleep: Callable[[float], None] = time.sleep, longest: float = 60.0) -> T_:
    """Result of a call, repeated after doubling pauses while its error is one that may pass (a retryable status or a
    broken connection). Any other error, and the last one, is raised as FatalError."""
    pause = 1.0
    for left in range(attempts - 1, -1, -1):
        try:
            return call()
        except (TruncatedResponse, FatalError):
            raise
        except Exception as e:
            passing = retryable(e.status) if isinstance(e, ProviderError) else isinstance(e, OSError)
            if not passing or not left:
                raise FatalError(f"{type(e).__name__}: {e}") from e
        sleep(min(longest, pause))
        pause *= 2
    raise FatalError("no attempts")


class Extractor(Protocol):
    def extract(self, prompt: str) -> str: ...


class Embedder(Protocol):
    dims: int

    def embed(self, texts: list[str]) -> list[list[float]]: ...


class RuleExtractor:
    """Deterministic stand-in for a language model: capitalised phrases as entities, none of its quality implied."""

    _NAME = re.compile(r"\b(?:[A-Z][a-z]{2,}(?: [A-Z][a-z]{2,})+)\b")

    def extract(self, prompt: str) -> str:
        import json

        names = list(dict.fromkeys(self._NAME.findall(prompt)))
        return json.dumps({"entities": [{"name": n, "type": "Other", "definition": "", "aliases": [], "section_ids": [], "salience": "mentioned"} for n in names], "relationships": []})


class HashEmbedder:
    """Deterministic stand-in for an embedding model: signed hashes of words, as unit vectors."""

    def __init__(self, dims: int = 64):
        self.dims = dims

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), self.dims))
        for i, t in enumerate(texts):
            for w in re.findall(r"\w+", t.lower()):
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                out[i, h % self.dims] += 1 if h >> 63 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norm > 0, norm, 1)).astype("float32").tolist()


def _asked(model: Extractor, prompt: str, attempts: int, sleep: Callable[[float], None]) -> str:
    """An answer to a schema-bound request, or, from a service that refuses the schema (status 400), to a plain one."""
    try:
        return attempted(lambda: model.extract(prompt), attempts, sleep)
    except FatalError as e:
        plain = getattr(model, "extract_plain", None)
        if plain is None or not isinstance(e.__cause__, ProviderError) or e.__cause__.status != 400:
            raise
        return attempted(lambda: plain(prompt), attempts, sleep)


def extract_all(chunks: DataFrame, make: Callable[[], Extractor], max_splits: int = 2, attempts: int = 6, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(key, result, error) of chunks (key, prompt). A truncated answer halves the prompt at a paragraph, up to
    max_splits times, and the parts' answers come as several rows. Errors that may pass are tried again, a refused
    schema is given up for a plain request (extract_plain, if the model has it); the error that remains is a value,
    never a failed task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()

        def answers(prompt: str, splits: int) -> list[tuple[str | None, str | None]]:
            try:
                return [(_asked(model, prompt, attempts, sleep), None)]
            except TruncatedResponse:
                parts = prompt.split("\n\n")
                if splits <= 0 or len(parts) < 2:
                    return [(None, "truncated")]
                mid = len(parts) // 2
                return answers("\n\n".join(parts[:mid]), splits - 1) + answers("\n\n".join(parts[mid:]), splits - 1)
            except FatalError as e:
                return [(None, str(e))]

        for batch in batches:
            rows = [(k, result, err) for k, p in zip(batch["key"], batch["prompt"], strict=True) for result, err in answers(p or "", max_splits)]
            yield pd.DataFrame(rows, columns=["key", "result", "error"])

    return chunks.select("key", "prompt").mapInPandas(run, "key string, result string, error string")


def embed_query(text: str, embedder: Embedder, attempts: int = 4, sleep: Callable[[float], None] = time.sleep) -> list[float]:
    """Vector of one query, on the driver. Errors that may pass are tried again; what remains is a FatalError, and so is
    a blank query or another number of vectors than one."""
    if not text.strip():
        raise FatalError("a query is needed")
    got = attempted(lambda: embedder.embed([text]), attempts, sleep)
    if len(got) != 1:
        raise FatalError(f"{len(got)} vectors for one text")
    return [float(x) for x in got[0]]


def embedding_text(head: str, body: str) -> Column:
    """`head`, a blank line, and `body`; only the body without a head."""
    h, b = F.coalesce(F.col(head), F.lit("")), F.coalesce(F.col(body), F.lit(""))
    return F.when(h == "", b).otherwise(F.concat(h, F.lit("\n\n"), b))


def embed_all(rows: DataFrame, make: Callable[[], Embedder], dims: int, model: str, cache: DataFrame | None = None, batch: int = 64, attempts: int = 6) -> DataFrame:
    """rows (id, text) with key, embedding and embedding_model. Keys already cached aren't embedded again; equal texts
    are embedded once. Errors that may pass are tried again; a model that returns another number of vectors than it got
    texts is an error."""
    keyed = rows.withColumn("key", T.content_key([F.lit(model), F.lit(dims), F.col("text")]))  # null is the empty text
    wanted = keyed.groupBy("key").agg(F.coalesce(F.min("text"), F.lit("")).alias("text"))
    hits, todo = cache_split(wanted, cache) if cache is not None else (None, wanted)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embedder = make()
        for pdf in batches:
            vectors: list[list[float]] = []
            for at in range(0, len(pdf), batch):
                texts = pdf["text"].iloc[at : at + batch].tolist()
                got = attempted(lambda: embedder.embed(texts), attempts)
                if len(got) != len(texts):
                    raise FatalError(f"{len(got)} vectors for {len(texts)} texts")
                vectors += got
            yield pd.DataFrame({"key": pdf["key"], "embedding": vectors})

    made = todo.select("key", "text").mapInPandas(run, "key string, embedding array<float>")
    if hits is not None:
        made = made.unionByName(hits.select("key", F.col("result").alias("embedding")))
    return keyed.join(made, "key").withColumn("embedding_model", F.lit(model))
