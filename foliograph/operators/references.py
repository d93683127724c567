"""References to records that don't exist, no longer exist or exist only later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.functions import ids
from foliograph.operators.skew import Split
from foliograph.session import cut


def section_node(df: DataFrame) -> Column:
    return ids.last_segment(df["base_path"])


def node_states(sections: DataFrame) -> DataFrame:
    """One row per node id: (node_id, gone, first_ok).

    gone says whether the newest row, by crawled_at and then page_id, is a failed fetch; first_ok is the first
    successful crawled_at, null if there is none. Rows without a usable base_path have no node. Both are plain
    aggregates that combine before the shuffle, so a page fetched any number of times costs one row.
    """
    rows = sections.select(section_node(sections).alias("node_id"), "crawled_at", "page_id", F.col("error").isNotNull().alias("failed"))
    return (
        rows.filter("node_id is not null")
        .groupBy("node_id")
        .agg(
            F.max_by("failed", F.struct(F.col("crawled_at"), F.col("page_id"))).alias("gone"),
            F.min(F.when(~F.col("failed"), F.col("crawled_at"))).alias("first_ok"),
        )
    )


def page_references(sections: DataFrame, extractions: DataFrame) -> DataFrame:
    """All references as (table_name, ref_field, row_id, target_id, at), one row per row, field and target.

    Null arrays, null elements and values that name no page give no reference. Children refer by section_id and,
    where that is null, by base_path.
    """
    child = sections.select("page_id", "crawled_at", F.explode("child_sections").alias("x")).select(
        F.lit("sections").alias("table_name"), F.lit("child_sections").alias("ref_field"), F.col("page_id").alias("row_id"),
        ids.node_id(F.col("x.section_id"), F.col("x.base_path")).alias("target_id"), F.col("crawled_at").alias("at"),
    )
    cross = sections.select("page_id", "crawled_at", F.explode("cross_references").alias("x")).select(
        F.lit("sections").alias("table_name"), F.lit("cross_references").alias("ref_field"), F.col("page_id").alias("row_id"),
        ids.href_target(F.col("x.href")).alias("target_id"), F.col("crawled_at").alias("at"),
    )
    mention = extractions.select("mention_id", "extracted_at", F.explode("section_ids").alias("x")).select(
        F.lit("extractions").alias("table_name"), F.lit("section_ids").alias("ref_field"), F.col("mention_id").alias("row_id"),
        ids.mention_target(F.col("x")).alias("target_id"), F.col("extracted_at").alias("at"),
    )
    return child.unionByName(cross).unionByName(mention).filter("target_id is not null")


_KEYS = ["table_name", "ref_field", "target_id", "period"]


def _verdicts(per: DataFrame, states: DataFrame, heavy_share: float) -> DataFrame:
    """(target_id, fault, first_ok, heavy) of the targets that are at fault for at least one reference or heavy; fault is
    null for a heavy one that is in order.

    A target is heavy if it has at least heavy_share of all references, at fault or not, so there are at most
    1/heavy_share of them. The left side has one row per target, so the shuffle join (an anti-join for the missing ones)
    can't be skewed.
    """
    keys = cut(per.groupBy("target_id").agg(F.sum("n").alias("n"), F.min("at_min").alias("at_min")))
    total = keys.agg(F.sum("n")).scalar()
    joined = keys.join(states, keys["target_id"] == states["node_id"], "left")
    fault = F.when(F.col("node_id").isNull(), "missing").when(F.col("gone"), "gone").when(F.col("first_ok") > F.col("at_min"), "late")
    heavy = F.col("n") >= total * heavy_share
    return cut(joined.select("target_id", fault.alias("fault"), "first_ok", heavy.alias("heavy")).filter("fault is not null or heavy"))


def _split_join(refs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """refs joined with the verdicts at fault: heavy targets by broadcast, the rest by a shuffle join, both united.

    References to heavy targets, the many to a page that is in order above all, leave before the shuffle; what is
    broadcast is bounded at any size of the data.
    """
    heavy = verdicts.filter("heavy")
    hot = refs.join(F.broadcast(heavy.filter("fault is not null").drop("heavy")), "target_id")
    cold = refs.join(F.broadcast(heavy.select("target_id")), "target_id", "left_anti").join(verdicts.filter("not heavy").drop("heavy"), "target_id")
    return hot.unionByName(cold)


def _checked(refs: DataFrame, heavy_share: float) -> None:
    if not 0 < heavy_share <= 1:
        raise ValueError("heavy_share must be in (0, 1]")
    if missing := {"table_name", "ref_field", "row_id", "target_id", "at"} - set(refs.columns):
        raise ValueError(f"references lack {sorted(missing)}")


def _aggregated(refs: DataFrame, period: str) -> DataFrame:
    at = F.date_trunc(period, F.col("at"))
    return refs.groupBy("table_name", "ref_field", "target_id", at.alias("period")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("at_min"), F.max("at").alias("at_max"))


def orphan_references(refs: DataFrame, states: DataFrame, heavy_share: float = 0.001) -> DataFrame:
    """Each reference at fault: (table_name, ref_field, row_id, target_id, at, fault), distinct.

    fault is `missing` (no such node), else `gone` (its newest row is a failure), else `late` (it first existed
    after the reference was made; never if either time is null). Repeated references of a row are one case.
    Empty inputs give an empty result; without any nodes every reference is missing.
    """
    _checked(refs, heavy_share)
    verdicts = _verdicts(_aggregated(refs, "month"), states, heavy_share)
    rows = _split_join(refs.select("table_name", "ref_field", "row_id", "target_id", "at"), verdicts)
    return rows.filter((F.col("fault") != "late") | (F.col("first_ok") > F.col("at"))).drop("first_ok").distinct()


def orphan_counts(refs: DataFrame, states: DataFrame, period: str = "month", heavy_share: float = 0.001) -> DataFrame:
    """Counts of faulty references per (table_name, ref_field, period, fault): n_refs, n_targets.

    Counts come from references aggregated per key and period before any join. Only groups whose period holds the
    very moment the target appeared are counted from their rows. References without a time have period null.
    """
    _checked(refs, heavy_share)
    per = cut(_aggregated(refs, period))
    verdicts = _verdicts(per, states, heavy_share)
    faults = _split_join(per, verdicts)
    late = F.col("fault") == "late"
    whole = faults.filter(~late | (F.col("at_max") < F.col("first_ok"))).select(*_KEYS, "fault", "n")
    part = faults.filter(late & (F.col("at_min") < F.col("first_ok")) & (F.col("at_max") >= F.col("first_ok"))).select(*_KEYS, "fault", "first_ok")
    # only references to those targets are told apart by their keys, heavy ones by broadcast
    late_ones = verdicts.join(part.select("target_id").distinct(), "target_id", "left_semi").select("target_id", "heavy", F.lit("late").alias("fault"))
    rows = _split_join(refs, late_ones).withColumn("period", F.date_trunc(period, F.col("at"))).select(*_KEYS, "at")
    rows = Split(cut(rows), _KEYS).join(part).filter(F.col("at") < F.col("first_ok"))
    part = rows.groupBy(*_KEYS, "fault").agg(F.count(F.lit(1)).alias("n"))
    return (
        whole.unionByName(part)
        .groupBy("table_name", "ref_field", "period", "fault")
        .agg(F.sum("n").alias("n_refs"), F.count(F.lit(1)).alias("n_targets"))
    )
