"""Packing sections into word-budget chunks in document order, and what is made of the chunks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.functions import text as T


def eligible(sections: DataFrame, min_words: int = 25) -> DataFrame:
    """Sections worth extracting from: fetched, no contents page, enough words in text and description together."""
    words = T.word_count(F.concat_ws(" ", F.coalesce("text", F.lit("")), F.coalesce("description", F.lit(""))))
    return sections.filter(F.col("error").isNull() & ~F.coalesce("is_contents_page", F.lit(False)) & (words >= min_words))


def greedy_chunks(docs: DataFrame, budget: int = 1200, group: str = "slug", order: str = "pos", words: str = "words") -> DataFrame:
    """(group, order, piece_no, first_word, n_words, chunk_no): sections packed in order into chunks of the budget.

    A section that would take a chunk over the budget begins the next one. A section over the budget by itself becomes
    pieces of the budget, each a chunk of its own that nothing else joins. A section without words takes no room.

    What is packed next depends on all that came before, so a document is one ordered stream; only its numbers are
    shuffled and sorted, texts stay out, and the state is two counters, so memory doesn't grow with the document.
    """
    rows = docs.select(group, order, F.col(words).cast("bigint").alias("_w")).repartition(group).sortWithinPartitions(group, order)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, chunk, used = object(), -1, None  # used is None where the next section must open a chunk
        for batch in batches:
            out = []
            for name, at, n in zip(batch[group], batch[order], batch["_w"], strict=True):
                if name != current:
                    current, chunk, used = name, -1, None
                if n > budget:
                    for piece, first in enumerate(range(0, int(n), budget)):
                        chunk += 1
                        out.append((name, at, piece, first, min(budget, int(n) - first), chunk))
                    used = None
                    continue
                if used is None or used + n > budget and used > 0:
                    chunk, used = chunk + 1, 0
                used += n
                out.append((name, at, 0, 0, int(n), chunk))
            yield pd.DataFrame(out, columns=[group, order, "piece_no", "first_word", "n_words", "chunk_no"])

    kinds = dict(docs.dtypes)
    return rows.mapInPandas(pack, f"{group} {kinds[group]}, {order} {kinds[order]}, piece_no int, first_word int, n_words int, chunk_no int")


def first_chunks(chunks: DataFrame, n: int) -> DataFrame:
    """The first n chunks of each document."""
    return chunks.filter(F.col("chunk_no") < n)


def piece_text(text: Column, first_word: Column, n_words: Column) -> Column:
    """Words of a piece joined by single blanks."""
    words = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.slice(words, first_word + 1, F.greatest(n_words, F.lit(1))), " ")


def piece_heading(heading: Column, piece_no: Column) -> Column:
    """Heading of a piece: from the second on with its number."""
    return F.when(piece_no > 0, F.concat(heading, F.lit(" (continued "), (piece_no + 1).cast("string"), F.lit(")"))).otherwise(heading)


def halves(chunks: DataFrame) -> DataFrame:
    """Retry of chunks that came out too long: (…, half). Sections split at the middle of the list; a lone section at
    the middle word; a lone one under 200 words can't be split and gives no row.

    chunks has (chunk, pos, n_words), pos from 0.
    """
    sizes = chunks.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))
    rows = chunks.join(sizes, "chunk")
    many = rows.filter("n > 1").select("chunk", "pos", F.lit(0).alias("first_word"), "n_words", F.when(F.col("pos") < F.floor(F.col("n") / 2), 0).otherwise(1).alias("half"))
    mid = F.floor(F.col("n_words") / 2).cast("int")
    one = rows.filter((F.col("n") == 1) & (F.col("n_words") >= 200)).withColumn("half", F.explode(F.array(F.lit(0), F.lit(1))))
    one = one.select("chunk", "pos", F.when(F.col("half") == 0, 0).otherwise(mid).alias("first_word"), F.when(F.col("half") == 0, mid).otherwise(F.col("n_words") - mid).alias("n_words"), "half")
    return many.unionByName(one)


def prompt_part(section_id: Column, heading: Column, description: Column, text: Column) -> Column:
    """A section as it stands in a prompt: a rule with id and heading, the description unless the text holds it, the text."""
    desc = F.when((F.coalesce(description, F.lit("")) != "") & ~F.contains(text, description), F.concat(description, F.lit("\n"))).otherwise("")
    return F.concat(F.lit("=== ["), section_id, F.lit("] "), heading, F.lit(" ===\n"), desc, text)


def chunk_prompts(parts: DataFrame) -> DataFrame:
    """(slug, chunk_no, prompt, key) of chunks given as rows (slug, chunk_no, pos, section_id, part); a chunk holds at
    most its budget of words, so its parts fit one row."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "section_id", "part")))
    out = parts.groupBy("slug", "chunk_no").agg(ordered.alias("x"))
    return out.select("slug", "chunk_no", F.array_join(F.transform("x", lambda x: x["part"]), "\n\n").alias("prompt"), F.array_join(F.transform("x", lambda x: F.concat(x["section_id"], F.char(F.lit(0)), x["part"])), "\u0000").alias("_body"))


def chunk_keys(chunks: DataFrame, model: str, version: str = "1") -> DataFrame:
    """chunks with key, 32 hex digits over version, model and content; a changed text or model gives a new key."""
    return chunks.withColumn("key", T.content_key([F.lit(version), F.lit(model), F.col("_body")])).drop("_body")


def cache_split(wanted: DataFrame, cache: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """(hits with the cached result, rows still to do). Of several results of a key the one with the greatest seq wins."""
    last = cache.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by("result", "seq").alias("result"))
    return wanted.join(last, key), wanted.join(last, key, "left_anti")
