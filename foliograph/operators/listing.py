"""Listings of manuals and pages: first-seen rows, filters, order, completeness, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliograph.functions import text as T
from foliograph.operators.numbering import global_numbers


def first_seen(df: DataFrame, keys: list[str | Column], order: list[str]) -> DataFrame:
    """The first row, by `order`, of each key. Rows with a null key are one key like any other.

    The rows are reduced with a partial minimum per key before they are shuffled, so a key with any share of the rows
    moves one row per partition.
    """
    named = {f"_k{i}": (F.col(k) if isinstance(k, str) else k) for i, k in enumerate(keys)}
    rows = df.select(F.struct(*order).alias("_o"), F.struct(*df.columns).alias("_row"), *(c.alias(n) for n, c in named.items()))
    return rows.groupBy(*named).agg(F.min_by("_row", "_o").alias("_row")).select("_row.*")


def listed(manuals: DataFrame, formats: list[str] | None = None, organisation: str | None = None, slugs: list[str] | None = None) -> DataFrame:
    """Manuals of the formats, organisation and slugs asked for, ordered by title and slug.

    `all` or None takes every format. Slugs match in any case, with or without `.json`. Null organisations match none.
    """
    out = manuals
    if formats and "all" not in formats:
        out = out.filter(F.col("format").isin(*formats))
    if organisation:
        out = out.filter(F.exists("organisations", lambda o: o == organisation))
    if slugs:
        out = out.filter(F.lower("slug").isin(*[s.lower().removesuffix(".json") for s in slugs]))
    return out.orderBy("title", "slug")


def _placed() -> Column:
    order = W.partitionBy("slug").orderBy(F.coalesce("section_id", F.lit("")), F.coalesce("base_path", F.lit("")), "page_id")
    return (F.row_number().over(order) - 1).alias("position")


def _name() -> Column:
    return F.coalesce(F.nullif(F.col("section_id"), F.lit("")), F.col("base_path")).alias("section_id")


def positions(sections: DataFrame) -> DataFrame:
    """(page_id, slug, section_id, position): the number of each section in its manual by identifier and path. Of the
    sections only these names are sorted."""
    return sections.select("page_id", "slug", _name(), _placed())


def section_props(sections: DataFrame) -> DataFrame:
    """Property columns of sections with their defaults: title from heading, text stripped, flags never null, and
    position, see positions."""
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    return sections.select(
        "page_id", "slug", _name(), F.coalesce(filled("title"), filled("heading"), F.lit("")).alias("title"),
        F.coalesce("heading", F.lit("")).alias("heading"), F.coalesce("description", F.lit("")).alias("description"), T.strip(F.coalesce("text", F.lit(""))).alias("text"),
        F.coalesce("is_contents_page", F.lit(False)).alias("is_contents_page"), F.coalesce("withdrawn", F.lit(False)).alias("withdrawn"), _placed(),
    )


def next_chain(placed: DataFrame) -> DataFrame:
    """(src, dst) of consecutive sections, by position, of each manual. A manual of one section has none."""
    after = F.lead("section_id").over(W.partitionBy("slug").orderBy("position"))
    return placed.select("slug", F.col("section_id").alias("src"), after.alias("dst")).filter("dst is not null")


def measures(sections: DataFrame) -> DataFrame:
    """Counts recomputed from the text beside those delivered: chars, words, and whether it is a contents page."""
    has_children = F.coalesce(F.size("child_sections"), F.lit(0)) > 0
    text = F.coalesce("text", F.lit(""))
    return sections.select(
        "page_id", F.length(text).alias("chars"), T.word_count(F.col("text")).alias("words"), (has_children & (text == "")).alias("contents_page"),
        F.coalesce(F.length(text) == F.col("char_count"), F.lit(False)).alias("chars_agree"),
    )


def crawl_totals(sections: DataFrame) -> DataFrame:
    """Fetches, failures, words, characters and attachments per manual and, with a null slug, over all, in one pass."""
    return sections.rollup("slug").agg(
        F.count(F.lit(1)).alias("fetches"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("words"),
        F.coalesce(F.sum("char_count"), F.lit(0)).alias("chars"), F.coalesce(F.sum(F.greatest(F.size("attachments"), F.lit(0))), F.lit(0)).alias("attachments"), F.grouping("slug").alias("is_total"),
    )


def incomplete(sections: DataFrame, least_share: float = 1.0) -> DataFrame:
    """Manuals whose share of successful fetches is below least_share: partial listings not to be written."""
    per = sections.groupBy("slug").agg(F.count(F.lit(1)).alias("reported"), F.count_if(F.col("error").isNull()).alias("fetched"))
    return per.filter(F.col("fetched") < F.col("reported") * least_share)


def assert_complete(sections: DataFrame) -> DataFrame:
    """sections, or an error at run time at the first failed fetch."""
    return sections.filter(F.assert_true(F.col("error").isNull(), F.concat(F.lit("incomplete listing of "), F.coalesce("slug", F.lit("?")))).isNull())


def tally(df: DataFrame, column: str) -> DataFrame:
    """Counts by value with their rank, greatest first, then by value. Nulls are counted as a value. The ranks come from
    ranges of the sorted counts, so no task sees all values."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ranked = global_numbers(counts, [F.desc("n"), F.asc_nulls_first(column)], "rank")
    return ranked.withColumn("rank", (F.col("rank") + 1).cast("int"))


def count_map(df: DataFrame, group: str, column: str) -> DataFrame:
    """(group, counts) with counts as text `value:count`, greatest first, then by value."""
    n = df.filter(F.col(column).isNotNull()).groupBy(group, column).agg(F.count(F.lit(1)).alias("n"))
    packed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), F.col(column).alias("v"))))
    return n.groupBy(group).agg(F.array_join(F.transform(packed, lambda x: F.concat(x["v"], F.lit(":"), (-x["neg"]).cast("string"))), ",").alias("counts"))
