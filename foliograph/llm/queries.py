"""Queries of the operators in this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm import leakage, markup, names, packing, quality, survivor
from foliograph.llm.sql import SQL as SQL
from foliograph.session import read

Query = Callable[[SparkSession, str], DataFrame]


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return names.linked_pairs(names.link_names(read(spark, d, "entities")))


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    """Each key with the smallest key of its class and the number of keys linked to it."""
    rows = names.link_names(read(spark, d, "entities"))
    sizes = rows.groupBy("thing").agg(F.min("key").alias("class_key"), (F.count(F.lit(1)) - 1).alias("n_links"))
    return rows.join(sizes, "thing").select("key", "class_key", "n_links")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.surviving_values(read(spark, d, "entities")).select("key", "field", "entity_id")


def p5_records(spark: SparkSession, d: str) -> DataFrame:
    return survivor.surviving_records(read(spark, d, "entities"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    rows = markup.markup(read(spark, d, "sections"), "page_id")
    return rows.select("page_id", F.explode("kinds").alias("markup")).distinct()


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.markup(read(spark, d, "sections"), "page_id").select("page_id", F.col("clean").alias("text"), F.array_join("kinds", ",").alias("kinds"), *markup.COUNTS)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(read(spark, d, "documents"), read(spark, d, "eval_items")).select("item_id", "doc_id").distinct()


def p8_spans(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(read(spark, d, "documents"), read(spark, d, "eval_items"))


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(read(spark, d, "documents"), read(spark, d, "budgets"))


def p7_placed(spark: SparkSession, d: str) -> DataFrame:
    """Each document with its pieces and tokens for each budget, as packed: once and whole, or in as few pieces as can be."""
    rows = packing.pack(read(spark, d, "documents"), read(spark, d, "budgets")).groupBy("budget_id", "source", "doc_id")
    return rows.agg(F.count(F.lit(1)).alias("pieces"), F.sum("n_tokens").alias("tokens"), F.countDistinct("piece_no").alias("different"))


def p7_overfull(spark: SparkSession, d: str) -> DataFrame:
    """Number of containers of each budget that hold more than their capacity: none."""
    budgets = read(spark, d, "budgets")
    used = packing.pack(read(spark, d, "documents"), budgets).groupBy("budget_id", "source", "container_no").agg(F.sum("n_tokens").alias("t"))
    over = used.join(F.broadcast(budgets.limit(1_000)), "budget_id").filter("t > capacity_tokens").groupBy("budget_id").agg(F.count(F.lit(1)).alias("n"))
    return budgets.join(over, "budget_id", "left").select("budget_id", F.coalesce("n", F.lit(0)).alias("overfull"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    budgets = read(spark, d, "budgets")
    return packing.fill(packing.pack(read(spark, d, "documents"), budgets), budgets)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    rows = quality.text_quality(read(spark, d, "documents"), read(spark, d, "common_words"))
    return rows.filter("kind <> 'prose'").select("doc_id", "kind").distinct()


def p9_stats(spark: SparkSession, d: str) -> DataFrame:
    return quality.text_quality(read(spark, d, "documents"), read(spark, d, "common_words"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p3_found, p3_classes, p5_found, p5_records, p6_found, p6_clean, p7_pack, p7_placed, p7_overfull, p7_fill, p8_found, p8_spans, p9_found, p9_stats)}
