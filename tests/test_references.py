from __future__ import annotations

import datetime as dt

from foliograph.functions import ids
from foliograph.operators import references as R
from pyspark.sql import functions as F

DAY = dt.datetime(2024, 1, 1)


def at(n):
    return DAY + dt.timedelta(days=n)


SECTION = (
    "page_id bigint, base_path string, error string, crawled_at timestamp, child_sections array<struct<section_id:string,base_path:string>>, "
    "cross_references array<struct<href:string,text:string>>, page_id2 bigint"
)
MENTION = "mention_id bigint, section_ids array<string>, extracted_at timestamp, row_id bigint"


def tables(spark, sections, mentions=()):
    return spark.createDataFrame([(*s, 0) for s in sections], SECTION), spark.createDataFrame([(*m, 0) for m in mentions], MENTION)


def found(spark, sections, mentions=()):
    s, e = tables(spark, sections, mentions)
    refs, states = R.page_references(s, e), R.node_states(s)
    return refs, states, {(r.ref_field, r.row_id, r.target_id, r.fault) for r in R.orphan_references(refs, states).collect()}


def test_faults(spark):
    sections = [
        (1, "/guidance/m/a", None, at(0), [("B ", None), (None, "/guidance/m/C/"), (None, None), ("zz9", None)], [("/guidance/m/d#x", ""), ("https://other.example/guidance/m/q1", ""), ("/guidance/m", ""), (None, None)]),
        (2, "/guidance/m/b", "fetch_failed", at(3), None, None),
        (3, "/guidance/m/b", None, at(1), [], []),
        (4, "/guidance/m/c", None, at(2), None, None),
        (5, "/guidance/m/d", None, at(0), None, None),
        (6, None, "x", None, None, None),
    ]
    mentions = [(10, ["[A]", " a ", "ZZ9", None], at(0)), (11, None, at(0)), (12, ["c"], None)]
    _, _, got = found(spark, sections, mentions)
    assert got == {("child_sections", 1, "b", "gone"), ("child_sections", 1, "c", "late"), ("child_sections", 1, "zz9", "missing"), ("section_ids", 10, "zz9", "missing")}


def test_ties_take_the_greater_page_id(spark):
    sections = [(1, "/guidance/m/a", None, at(0), [("b", None)], None), (3, "/guidance/m/b", "gone", at(1), None, None), (2, "/guidance/m/b", None, at(1), None, None)]
    assert found(spark, sections)[2] == {("child_sections", 1, "b", "gone")}


def test_empty_tables_and_repeats(spark):
    assert found(spark, [])[2] == set()
    sections = [(1, "/guidance/m/a", None, at(0), [("x1", None), ("X1", None)], None)] * 2
    refs, states, got = found(spark, sections)
    assert got == {("child_sections", 1, "x1", "missing")}
    assert [tuple(r) for r in R.orphan_counts(refs, states).select("n_refs", "n_targets").collect()] == [(4, 1)]


def test_counts_agree_with_rows_under_skew(spark):
    """Half of all references name one target, and the target appears inside a period."""
    sections = [(i, f"/guidance/m/p{i}", None, at(i % 60), [("hot", None), (f"c{i % 7}", None)], None) for i in range(300)] + [(999, "/guidance/m/hot", None, at(20), None, None)]
    refs, states, _ = found(spark, sections)
    rows = R.orphan_references(refs, states).withColumn("period", F.date_trunc("month", "at"))
    want = {tuple(r) for r in rows.groupBy("ref_field", "period", "fault").agg(F.count(F.lit(1)), F.countDistinct("target_id")).collect()}
    for share in (0.001, 0.4):
        got = R.orphan_counts(refs, states, heavy_share=share).select("ref_field", "period", "fault", "n_refs", "n_targets")
        assert {tuple(r) for r in got.collect()} == want


def test_href_target(spark):
    hrefs = ["/internal-manuals/m/ab1?x=1", " /Guidance/m/AB2/ ", "http://www.manuals.example/guidance/m/c#f", "OPM10", "mailto:x", "#top", "/internal-manuals/m", "/about/m/x", "https://www.manuals.example.org/guidance/m/x", "", None]
    df = spark.createDataFrame([(h,) for h in hrefs], "h string")
    assert [r[0] for r in df.select(ids.href_target(F.col("h"))).collect()] == ["ab1", "ab2", "c", "opm10", None, None, None, None, None, None, None]
