"""Best representative of each group of duplicates, field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.functions import text as T

#: Beginnings of answers that decline to define anything, and fillers (in plain form).
REFUSALS = ("i could not", "i cannot", "i can't", "i am unable", "based on the supplied", "as an ai", "sorry", "no statement can be made")
FILLERS = ("", "?", "-", "unknown", "tbc", "tbd", "n/a", "none", "null", "to follow", "definition to follow", "see section", "see text", "no definition given", "not defined in the supplied text", "text does not say")


def definition_merit(definition: Column, key: Column) -> Column:
    """(grade, length) of a definition of the thing named by key; the greater is the fuller statement.

    Grade 5: a finished statement that begins with the thing's own name and says no sentence twice. 4: the same with
    repetition. 3: cut short. 2: about something else, or a refusal. 1: a filler. 0: null or blank. Finished is what
    ends with a full stop, question or exclamation mark, but not with dots or a dash.
    """
    text = T.collapse(definition)
    plain = T.norm(text)
    own = F.startswith(plain, key) & ~F.substring(plain, F.length(key) + 1, F.lit(1)).rlike("[a-z0-9]") & (F.length(plain) > F.length(key) + 8)
    done = text.rlike(r"[.!?][\"'”’)]?$") & ~text.rlike(r"(\.\.|…)[\"'”’)]?$")
    said = F.transform(F.split(F.lower(text), r"(?<=[.!?])\s+"), lambda s: F.trim(s))
    twice = F.size(F.array_distinct(said)) < F.size(said)
    filler = plain.isin(*FILLERS)
    refusal = F.coalesce(*(F.when(F.startswith(F.lower(text), F.lit(r)), True) for r in REFUSALS), F.lit(False))
    grade = (
        F.when(text.isNull() | (text == ""), 0).when(filler, 1).when(refusal | ~own, 2).when(~done, 3).when(twice, 4).otherwise(5)
    )
    return F.struct(grade.cast("int").alias("grade"), F.coalesce(F.length(text), F.lit(0)).alias("size"))


def _enum(value: Column, allowed: list[str]) -> Column:
    """The enum's spelling of a value, whatever its case and outer blanks; null if it isn't one."""
    table = F.create_map(*(F.lit(x) for v in allowed for x in (v.lower(), v)))
    return F.element_at(table, F.lower(T.collapse(value)))


#: Half-life, in days, of the votes that tell values of equal votes apart.
TIE_HALF_LIFE = 180.0


def unpivoted(entities: DataFrame, half_life_days: float | None = None) -> DataFrame:
    """Long rows (key, field, value, merit, vote, recent, entity_id, loaded_at), one per row and field.

    value is the normalised value, null if there is none. merit is trust without a limit: how good a statement the
    value is by itself. vote is the trust in the row (its mentions for the type, 1 otherwise), with a half-life times
    its recency; recent is the trust times the recency in any case. Recency halves for each half-life a row is older
    than the newest row of the table; only ratios within a key matter, so that one instant serves all keys. A row
    without a time has recency 0.
    """
    age = F.timestamp_diff("SECOND", F.col("loaded_at"), entities.agg(F.max("loaded_at")).scalar()) / 86400.0
    decay = F.coalesce(F.pow(F.lit(0.5), age / (half_life_days or TIE_HALF_LIFE)), F.lit(0.0))
    kind, salience = _enum(F.col("type"), T.ENTITY_TYPES), _enum(F.col("salience"), T.SALIENCE)
    merit = lambda grade, size: F.struct(grade.cast("int").alias("grade"), size.cast("int").alias("size"))
    zero = F.lit(0)
    fields = F.array(
        F.struct(F.lit("definition").alias("field"), F.nullif(T.collapse(F.col("definition")), F.lit("")).alias("value"), definition_merit(F.col("definition"), F.col("key")).alias("merit"), F.lit(1.0).alias("trust")),
        F.struct(F.lit("type").alias("field"), kind.alias("value"), merit(F.when(kind.isNull(), 0).when(kind == "Other", 1).otherwise(2), zero).alias("merit"), F.greatest(F.coalesce(F.col("mentions"), F.lit(0)), F.lit(0)).cast("double").alias("trust")),
        F.struct(F.lit("salience").alias("field"), salience.alias("value"), merit(T.salience_rank(salience), zero).alias("merit"), F.lit(1.0).alias("trust")),
    )
    long = entities.select("key", "entity_id", "loaded_at", decay.alias("decay"), F.explode(fields).alias("x"))
    recent = F.col("x.trust") * F.col("decay")
    return long.select("key", "x.field", "x.value", "x.merit", (recent if half_life_days else F.col("x.trust")).alias("vote"), recent.alias("recent"), "entity_id", "loaded_at")


def winners(long: DataFrame) -> DataFrame:
    """(key, field, value, entity_id, votes): the surviving value of each field of each key and the row it is from.

    Votes add up per value first, with a partial sum before the shuffle, so that a key with any number of rows moves
    as many rows as it has values. The best merit wins, then most votes, then most recent votes (to nine digits), then
    the newest row, then the smallest id; of rows with the surviving value the newest, then that with the smallest id.
    Without any value it is null.
    """
    newest = F.struct(F.col("loaded_at"), (-F.col("entity_id")).alias("neg"))
    values = long.groupBy("key", "field", "value", "merit").agg(F.sum("vote").alias("votes"), F.round(F.sum("recent"), 9).alias("recent"), F.max(newest).alias("row"))
    best = values.groupBy("key", "field").agg(F.max_by(F.struct("value", "row", "votes"), F.struct("merit", "votes", "recent", "row")).alias("x"))
    return best.select("key", "field", "x.value", (-F.col("x.row.neg")).alias("entity_id"), "x.votes")


def duplicated(entities: DataFrame) -> DataFrame:
    """Keys with at least two rows."""
    return entities.filter("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")


def surviving_values(entities: DataFrame, half_life_days: float | None = None) -> DataFrame:
    """(key, field, value, entity_id, votes) of keys with at least two rows. Null keys are left out."""
    long = unpivoted(entities.select("key", "entity_id", "definition", "type", "salience", "mentions", "loaded_at"), half_life_days)
    return winners(long).join(duplicated(entities), "key", "left_semi")


def surviving_records(entities: DataFrame, half_life_days: float | None = None) -> DataFrame:
    """One record per key with at least two rows: the surviving values side by side with the rows they are from, and the sum of mentions."""
    kept = surviving_values(entities, half_life_days)
    wide = kept.groupBy("key").pivot("field", ["definition", "type", "salience"]).agg(F.first("value").alias("value"), F.first("entity_id").alias("from"))
    totals = entities.groupBy("key").agg(F.sum("mentions").alias("mentions"), F.count(F.lit(1)).alias("n_rows"))
    named = {f"{f}_value": f for f in ("definition", "type", "salience")}
    return wide.withColumnsRenamed(named).join(totals, "key")
