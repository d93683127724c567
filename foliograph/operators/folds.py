"""Folds of extracted mentions and relationships into keyed rows, per document and over all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliograph.functions import text as T


def _stripped(c: str) -> Column:
    return T.strip(F.coalesce(F.col(c), F.lit("")))


def _union(arrays: Column) -> Column:
    """Sorted distinct elements of the arrays of a group. The distinct arrays are combined before the shuffle, so
    repeated rows of a hot key cost nothing."""
    return F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_set(arrays)), lambda x: x.isNotNull() & (x != ""))))


def _salience(rank: str, value: str, seq: str) -> Column:
    """Greatest known salience; without any, the first value as it came, or `mentioned`."""
    best = F.max(rank)
    return F.when(best > 0, F.element_at(F.array(*map(F.lit, T.SALIENCE)), F.when(best > 0, best).otherwise(1))).otherwise(F.coalesce(F.min_by(value, seq), F.lit("mentioned")))


def valid_ids(ids: Column, known: Column) -> Column:
    """Ids that the document has; all of them if it has none."""
    return F.when(F.size(known) > 0, F.array_intersect(ids, known)).otherwise(ids)


def entity_fold(mentions: DataFrame, doc: str = "slug", order: tuple[str, ...] = ("chunk_no", "mention_id")) -> DataFrame:
    """One row per document and normalised name: (doc, key, name, type, definition, aliases, section_ids, salience, mentions).

    Type is the first seen, `Other` where it is null or blank; name and definition are those of the longest
    (stripped) definition, the earlier in a tie; salience the greatest; aliases the sorted set without those that
    normalise to the key; section ids the sorted set. Keys shorter than two characters are dropped. Null arrays count
    as empty. Sections ids must have been checked before, see valid_ids.
    """
    key = T.norm(F.col("name"))
    definition = _stripped("definition")
    seq = F.struct(*order)
    back = F.struct(F.length("def"), *((-F.col(c)).alias(f"neg_{c}") for c in order))
    rows = mentions.select(
        doc, *order, key.alias("key"), _stripped("name").alias("name"), F.coalesce(F.nullif(F.col("type"), F.lit("")), F.lit("Other")).alias("type"), definition.alias("def"),
        F.nullif(F.col("salience"), F.lit("")).alias("salience"), T.salience_rank(F.col("salience")).alias("rank"),
        F.transform(F.coalesce("aliases", F.array().cast("array<string>")), T.strip).alias("aliases"), F.coalesce("section_ids", F.array().cast("array<string>")).alias("section_ids"),
    ).filter(F.length("key") >= 2)
    out = rows.withColumn("seq", seq).withColumn("back", back).groupBy(doc, "key").agg(
        F.max_by(F.struct("name", "def"), "back").alias("best"), F.min_by("type", "seq").alias("type"), _union(F.col("aliases")).alias("aliases"),
        _union(F.col("section_ids")).alias("section_ids"), _salience("rank", "salience", "seq").alias("salience"), F.count(F.lit(1)).alias("mentions"),
    )
    own = F.filter("aliases", lambda a: T.norm(a) != F.col("key"))
    return out.select(doc, "key", F.col("best.name").alias("name"), "type", F.col("best.def").alias("definition"), own.alias("aliases"), "section_ids", "salience", "mentions")


def alias_map(entities: DataFrame, doc: str = "slug", order: str = "key") -> DataFrame:
    """(doc, alias_key, key): the first entity, by `order`, that an alias names. Blank aliases name none."""
    rows = entities.select(doc, F.col("key"), F.col(order).alias("_o"), F.explode("aliases").alias("a")).select(doc, T.norm(F.col("a")).alias("alias_key"), "key", "_o").filter("alias_key <> ''")
    return rows.groupBy(doc, "alias_key").agg(F.min_by("key", F.struct("_o", "key")).alias("key"))


def loaded_names(loads: DataFrame, doc: str = "slug", order: tuple[str, ...] = ("loaded_at", "entity_id")) -> DataFrame:
    """(doc, key, aliases, first) of loaded entities: all aliases of the loads of a key, and the place of the first."""
    rows = loads.filter("key is not null").withColumn("first", F.struct(*order))
    return rows.groupBy(doc, "key").agg(_union(F.coalesce("aliases", F.array().cast("array<string>"))).alias("aliases"), F.min("first").alias("first"))


def name_map(entities: DataFrame, doc: str = "slug", order: str = "key") -> DataFrame:
    """(doc, name_key, key), one row a name: an entity's own key stands for itself, whatever aliases say."""
    own = entities.select(doc, F.col("key").alias("name_key"), F.lit(0).alias("_alias"), "key")
    said = alias_map(entities, doc, order).select(doc, F.col("alias_key").alias("name_key"), F.lit(1).alias("_alias"), "key")
    return own.unionByName(said).groupBy(doc, "name_key").agg(F.min_by("key", F.struct("_alias", "key")).alias("key"))


def resolve(names: DataFrame, name: str, entities: DataFrame, into: str, doc: str = "slug", order: str = "key") -> DataFrame:
    """names with the key each name resolves to: an entity's key, else the key an alias stands for, else null."""
    known = name_map(entities, doc, order).select(F.col(doc).alias("_d"), F.col("name_key").alias("_k"), F.col("key").alias(into))
    keyed = names.withColumn("_n", T.norm(F.col(name)))
    return keyed.join(known, (F.col(doc) == F.col("_d")) & (F.col("_n") == F.col("_k")), "left").drop("_n", "_d", "_k")


def relationship_ok() -> Column:
    """Both ends resolve, to different entities, and the type is in the enum."""
    return F.coalesce(F.col("source_key").isNotNull() & F.col("target_key").isNotNull() & (F.col("source_key") != F.col("target_key")) & F.col("type").isin(*T.RELATIONSHIP_TYPES), F.lit(False))


def relationship_fold(rows: DataFrame, doc: str = "slug", seq: str = "seq") -> DataFrame:
    """One row per (doc, source_key, type, target_key): mentions, evidence in first-seen order, sorted section ids.

    rows are resolved relationships (doc, seq, source_key, type, target_key, evidence, section_ids), one each, with
    their evidence as an array (or one quote); those that fail relationship_ok are dropped, see dropped_counts. Blank and repeated
    evidence doesn't count. Evidence is combined per quote before the shuffle.
    """
    ok = rows.filter(relationship_ok())
    key = [doc, "source_key", "type", "target_key"]
    folded = ok.groupBy(*key).agg(F.count(F.lit(1)).alias("mentions"), _union(F.coalesce("section_ids", F.array().cast("array<string>"))).alias("section_ids"))
    quotes = F.col("evidence") if dict(rows.dtypes)["evidence"].startswith("array") else F.array("evidence")
    said = ok.select(*key, seq, F.posexplode(quotes).alias("_at", "e")).select(*key, F.struct(seq, "_at").alias("at"), T.strip(F.col("e")).alias("e"))
    said = said.filter("e <> ''").groupBy(*key, "e").agg(F.min("at").alias("at"))
    said = said.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "e"))), lambda x: x["e"]).alias("evidence"))
    return folded.join(said, key, "left").withColumn("evidence", F.coalesce("evidence", F.array().cast("array<string>")))


def dropped_counts(rows: DataFrame, doc: str = "slug") -> DataFrame:
    return rows.groupBy(doc).agg(F.count_if(~relationship_ok()).alias("dropped"), F.count(F.lit(1)).alias("total"))


def entity_upsert(loads: DataFrame, order: tuple[str, ...] = ("loaded_at", "entity_id")) -> DataFrame:
    """Loads of entities folded by key over all documents, as repeated loading would leave them.

    The longest name, first non-null type and longest definition win, each by itself and the earlier in a tie; aliases
    are united; created_from is the first load's. Null keys are left out.
    """
    seq = F.struct(*order)
    # timestamps can't be negated, so earlier-in-a-tie is a count back from the far end
    age = [(-F.unix_micros(F.col(c).cast("timestamp")) if dict(loads.dtypes)[c].startswith("timestamp") else -F.col(c)).alias(f"neg_{c}") for c in order]
    longest = lambda c: F.max_by(_stripped(c), F.struct(F.length(_stripped(c)), *age))
    return loads.filter("key is not null").groupBy("key").agg(
        longest("name").alias("name"), F.min_by("type", F.when(F.col("type").isNotNull(), seq)).alias("type"), longest("definition").alias("definition"),
        _union(F.coalesce("aliases", F.array().cast("array<string>"))).alias("aliases"), F.min_by("created_from", seq).alias("created_from"), F.count(F.lit(1)).alias("loads"),
    )


def discusses_upsert(loads: DataFrame) -> DataFrame:
    """(slug, key, salience, salience_rank, mentions): the greatest salience, which never falls, and mentions summed."""
    rank = T.salience_rank(F.lower(F.trim("salience")))
    best = F.max(rank)
    named = F.when(best > 0, F.element_at(F.array(*map(F.lit, T.SALIENCE)), F.when(best > 0, best).otherwise(1)))
    return loads.filter("key is not null").groupBy("slug", "key").agg(named.alias("salience"), best.alias("salience_rank"), F.sum("mentions").alias("mentions"))


def edge_upsert(loads: DataFrame, seq: str = "seq") -> DataFrame:
    """(source_key, type, target_key): evidence united, mentions of the last load, created_from of the first."""
    return loads.groupBy("source_key", "type", "target_key").agg(_union(F.col("evidence")).alias("evidence"), F.max_by("mentions", seq).alias("mentions"), F.min_by("created_from", seq).alias("created_from"))


def entity_order() -> list[Column]:
    """Greatest salience, most mentions, then name in lower case and key."""
    return [T.salience_rank(F.col("salience")).desc(), F.desc("mentions"), F.lower("name"), F.asc("key")]


def relationship_order() -> list[Column]:
    """Most mentions, then source in lower case, type, and target in lower case."""
    return [F.desc("mentions"), F.lower("source_key"), F.asc("type"), F.lower("target_key"), F.asc("source_key"), F.asc("target_key")]


def placed(rows: DataFrame, order: list[Column], column: str, doc: str = "slug") -> DataFrame:
    """rows with their place, from 0, in their document's list."""
    return rows.withColumn(column, (F.row_number().over(W.partitionBy(doc).orderBy(*order)) - 1).cast("int"))


def back_pointers(entities: DataFrame, relationships: DataFrame | None = None) -> DataFrame:
    """(slug, section_id, entity_mentions, relationship_refs): sorted distinct keys of the entities that name a section,
    and sorted places, in the document's list of relationships, of those that do. Without relationships the latter
    column is left out."""
    rows = entities.select("slug", "key", F.explode("section_ids").alias("section_id"))
    said = rows.groupBy("slug", "section_id").agg(F.array_sort(F.collect_set("key")).alias("entity_mentions"))
    if relationships is None:
        return said
    at = placed(relationships, relationship_order(), "place").select("slug", "place", F.explode("section_ids").alias("section_id"))
    refs = at.groupBy("slug", "section_id").agg(F.array_sort(F.collect_set("place")).alias("relationship_refs"))
    none = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)
    return said.join(refs, ["slug", "section_id"], "full").select("slug", "section_id", none("entity_mentions", "string"), none("relationship_refs", "int"))


def attach_to_sections(sections: DataFrame, pointers: DataFrame) -> DataFrame:
    """sections with the pointers of back_pointers in place of any they had. Only sections with a section_id get some,
    and of several with the same id the last, by page_id; the others have none."""
    bare = sections.drop("entity_mentions", "relationship_refs")
    last = bare.filter("section_id is not null").groupBy("slug", "section_id").agg(F.max("page_id").alias("page_id"))
    to = last.join(pointers, ["slug", "section_id"]).drop("slug", "section_id")
    return bare.join(to, "page_id", "left")
