from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from foliograph.llm import survivor as S

COLUMNS = "entity_id bigint, key string, definition string, type string, salience string, mentions bigint, loaded_at timestamp, value string"


def frame(spark, rows):
    return spark.createDataFrame([(i, k, d, t, s, m, dt.datetime(2024, 1, day), "clash") for i, k, d, t, s, m, day in rows], COLUMNS)


def kept(spark, rows, **kw):
    return {(r.key, r.field): (r.value, r.entity_id) for r in S.surviving_values(frame(spark, rows), **kw).collect()}


def test_fields(spark):
    rows = [
        (1, "x levy", "X Levy limits the charge. It applies.", " levy ", "mentioned", 5, 1), (2, "x levy", "X Levy limits the charge. It applies. It applies.", "Other", "PRIMARY", 90, 2),
        (3, "x levy", "X Levy limits the charge. It appl…", "Duty", "high", 7, 3), (4, "x levy", "Y Board limits the charge. It applies. It is longer than that.", None, None, None, 4),
        (5, "x levy", "I could not find a definition in the text provided, but it goes on.", "LEVY", "secondary ", 3, 5), (6, "x levy", "X Levy limits the charge. It applies.", "Levy", "primary", 0, 1), (7, "one", "One is one of one.", "Tax", "primary", 1, 1),
    ]
    got = kept(spark, rows)
    assert got == {("x levy", "definition"): ("X Levy limits the charge. It applies.", 1), ("x levy", "type"): ("Levy", 5), ("x levy", "salience"): ("primary", 2)}


def test_nothing_usable_and_ties(spark):
    got = kept(spark, [(2, "k", None, None, None, None, 1), (1, "k", "", "junk", "high", 0, 1)])
    assert got == {("k", f): (None, 1) for f in ("definition", "type", "salience")}
    got = kept(spark, [(4, "k", "tbc", "Tax", "primary", 1, 1), (3, "k", "-", "Tax", "primary", 1, 1)])
    assert got[("k", "type")] == ("Tax", 3)


def test_decay_changes_the_vote(spark):
    rows = [(1, "k", None, "Tax", None, 10, 1), (2, "k", None, "Duty", None, 4, 29)]
    assert kept(spark, rows)[("k", "type")] == ("Tax", 1)
    assert kept(spark, rows, half_life_days=7)[("k", "type")] == ("Duty", 2)


def test_recency_tells_equal_votes_apart(spark):
    rows = [(1, "k", None, "Tax", None, 5, 1), (2, "k", None, "Tax", None, 5, 30), (3, "k", None, "Duty", None, 2, 29), (4, "k", None, "Duty", None, 8, 29)]
    assert kept(spark, rows)[("k", "type")] == ("Duty", 3)  # ten mentions each, the newest row is one of Tax
    assert kept(spark, [*rows, (5, "k", None, "Tax", None, 1, 1)])[("k", "type")] == ("Tax", 2)


def test_rows_without_a_time(spark):
    df = frame(spark, [(1, "k", "K is a thing here.", "Tax", "primary", 2, 1), (2, "k", None, "Tax", None, 3, 2)])
    got = S.surviving_values(df.withColumn("loaded_at", F.lit(None).cast("timestamp"))).collect()
    assert {(r.field, r.entity_id) for r in got} == {("definition", 1), ("type", 1), ("salience", 1)}


def test_closing_dots_and_empty(spark):
    got = kept(spark, [(1, "x b assoc", "X B Assoc. limits the charge.", "Tax", None, 1, 1), (2, "x b assoc", "X B Associates limit the charge entirely.", "Tax", None, 1, 1)])
    assert got[("x b assoc", "definition")][1] == 1
    assert kept(spark, []) == {} and kept(spark, [(1, None, "x", "Tax", None, 1, 1), (2, None, "x", "Tax", None, 1, 1)]) == {}


def test_records(spark):
    r = S.surviving_records(frame(spark, [(1, "k", "K is a thing here.", "Tax", "primary", 2, 1), (2, "k", None, "Tax", None, 3, 2)])).first()
    assert (r.definition, r.definition_from, r.type, r.type_from, r.mentions, r.n_rows) == ("K is a thing here.", 1, "Tax", 2, 5, 2)
