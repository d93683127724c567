"""Deeply nested JSON records to flat related tables.

Records are read as variants. A merged schema is found by aggregates in the JVM, and every list in it becomes a level:
a child table whose rows know their parent and their place. All levels come out of one pass and one explode.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the records' format: fields that are lists even where only lone elements are delivered, fields whose
#: elements only group those of a list of the same level, and fields that are other names of one thing.
LISTS = frozenset("sections child_sections child_section_groups cross_references attachments entities relationships evidence aliases section_ids organisations".split())
GROUPS = {"child_sections": "child_section_groups"}
SAME = {"pages": "sections", "result": "enrichment"}
#: Names of the elements of the levels.
ELEMENTS = {
    "sections": "section", "sections.child_sections": "child_section", "sections.cross_references": "cross_reference", "sections.attachments": "attachment",
    "enrichment.entities": "entity", "enrichment.relationships": "relationship", "enrichment.relationships.evidence": "evidence",
}


#: Fields within fields that are taken apart, the record's own being the first; what lies deeper stays JSON text in its
#: column. Records with more brackets within each other than READ_DEPTH don't take part in the schema, as the reader of
#: types can't go that deep; they are flattened by the schema of the others.
MAX_DEPTH, READ_DEPTH = 8, 100


def canonical(name: str) -> str:
    """Field name in snake case, so that the names of several schema versions fall together."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip()).lower().replace("-", "_")


# --------------------------------------------------------------------------- access to variants, all in the JVM
#
# Expressions over variants are SQL text: a schema makes thousands of them, and as text they go to the JVM in one call.

Expr = str
_names = count()


def _literal(s: str) -> Expr:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _each(values: Expr, body: Callable[..., Expr], how: str = "transform", place: bool = False) -> Expr:
    """A higher-order function over an array, with names of its own for the element and, if asked for, its place."""
    x = f"x{next(_names)}"
    return f"{how}({values}, ({x}, {x}i) -> {body(x, f'{x}i')})" if place else f"{how}({values}, {x} -> {body(x)})"


def _let(value: Expr, body: Callable[[Expr], Expr]) -> Expr:
    """body of a value that is computed once, however often the body names it."""
    return f"{_each(f'array({value})', body)}[0]"


_NO_VARIANTS = "cast(array() as array<variant>)"
_ANY_SCALAR = "parse_json('0')"
_LIST_TEXT, _OBJECT_TEXT, _PLAIN_TEXT = r"'^\\s*\\['", r"'^\\s*\\{'", r"'^\\s*[^\\s\\[{]'"


def _as(v: Expr, kind: str) -> Expr:
    return f"try_variant_get({v}, '$', '{kind}')"


def _is_object(v: Expr) -> Expr:
    return f"({_as(v, 'map<string,variant>')} is not null)"


def _nothing(v: Expr) -> Expr:
    return f"({v} is null or is_variant_null({v}))"


def _parsed(s: Expr, beginning: Expr) -> Expr:
    return f"try_parse_json(case when {s} rlike {beginning} then {s} end)"


def _field(v: Expr, names: list[str]) -> Expr:
    """The first of the fields that is there and not null."""
    at = [f"try_variant_get({v}, {_literal(f'$[{chr(34)}{n}{chr(34)}]' if chr(34) not in n else f'$[{chr(39)}{n}{chr(39)}]')}, 'variant')" for n in names]
    return at[0] if len(at) == 1 else f"get({_each(f'array({chr(44).join(at)})', lambda x: f'not {_nothing(x)}', 'filter')}, 0)"


def _object(v: Expr) -> Expr:
    """The object in a string that is one; else the value as it is."""
    return _let(v, lambda v: f"case when {_is_object(v)} then {v} else coalesce({_let(_as(v, 'string'), lambda s: _parsed(s, _OBJECT_TEXT))}, {v}) end")


def _elements(v: Expr) -> Expr:
    def text(s: Expr) -> Expr:
        return f"case when trim({s}) = '' then {_NO_VARIANTS} else {_as(_parsed(s, _LIST_TEXT), 'array<variant>')} end"

    lone = f"case when {_is_object(v)} then array({v}) else coalesce({_let(_as(v, 'string'), text)}, array({_object(v)})) end"
    return f"case when {_nothing(v)} then {_NO_VARIANTS} else coalesce({_as(v, 'array<variant>')}, {lone}) end"


def elements(v: Expr) -> Expr:
    """Value to an array of variants, whatever its shape: a list, a list or object in a string, or a lone element. Null
    and blank strings have no element; null elements keep their places."""
    return _let(v, _elements)


def _too_deep(text: Expr) -> Expr:
    """Whether the text of a record has more than READ_DEPTH brackets within each other: pairs that hold nothing are taken out, from
    the inside, as often. Brackets in strings may be left over, so the strings go first where something is left."""

    def left(text: Expr) -> Expr:
        brackets = rf"regexp_replace({text}, '[^\\[\\]{{}}]+', '')"
        return rf"aggregate(sequence(1, {READ_DEPTH}), {brackets}, (t, i) -> case when t = '' then t else regexp_replace(t, '\\[\\]|\\{{\\}}', '') end)"

    def deep(text: Expr) -> Expr:
        bare = rf"""regexp_replace({text}, '"(?:[^"\\\\]++|\\\\.)*+"', '')"""
        few = f"length({text}) - length(translate({text}, '[{{', '')) <= {READ_DEPTH}"  # opened at all
        return f"case when {few} or {left(text)} = '' then false else {left(bare)} <> '' end"

    return _let(text, deep)


def record_variants(records: DataFrame, id_column: str, payload_column: str) -> DataFrame:
    """(record_id, doc, deep): the record itself, of records that are complete JSON objects or lists, and whether it is
    nested too deep for the schema.

    A byte order mark, a code fence and JSON strings around the record are taken off. Each wrapping doubles the
    backslashes, so a text can't be wrapped more often than the logarithm of its length, and that many steps unwrap any.
    """
    raw = F.col(payload_column)
    bare = F.regexp_replace(raw, r"^[\s﻿]*(?:```[A-Za-z]*\s*)?", "")
    bare = F.when(bare.rlike(r"```\s*$"), F.rtrim(F.regexp_replace(bare, r"```\s*$", ""))).otherwise(bare)

    def unwrap(text: Column, _: Column) -> Column:
        return F.when(text.startswith('"'), F.trim(F.try_variant_get(F.try_parse_json(text), "$", "string"))).otherwise(text)

    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.length(raw) + 2)).cast("int"))
    wrapped = F.aggregate(steps, bare, unwrap, lambda text: F.when(text.rlike(r"^[{\[]"), F.try_parse_json(text)))
    plain = F.when(raw.rlike(r"^[{\[]"), F.try_parse_json(raw))
    rows = records.select(F.col(id_column).alias("record_id"), F.coalesce(plain, wrapped).alias("doc"), F.when(raw.rlike(r"^[{\[]"), raw).alias("_text")).filter("doc is not null")
    text = f"coalesce(_text, {_as('doc', 'string')})"
    return rows.selectExpr("record_id", "doc", f"{_too_deep(text)} as deep")


# --------------------------------------------------------------------------- merged schema


@dataclass
class Field:
    """What a field was seen as, over all records: its spellings, and whether as scalar, list or object."""

    spelt: list[str] = field(default_factory=list)
    scalar: bool = False
    list: bool = False
    object: bool = False
    strings: bool = False  # elements are objects in strings
    inside: dict[str, Field] = field(default_factory=dict)

    def is_level(self, name: str) -> bool:
        return self.list or name in LISTS and (self.object or self.scalar)

    def walk(self, path: str = "") -> Iterator[tuple[str, Field]]:
        for name, f in sorted(self.inside.items()):
            yield f"{path}{name}", f
            yield from f.walk(f"{path}{name}.")


def parsed_type(text: str) -> tuple:
    """Tree of the text of a variant's type: ('OBJECT', {name: tree}), ('ARRAY', tree) or (scalar,)."""
    at = 0

    def name() -> str:
        nonlocal at
        if text[at] == "`":
            end = at + 1
            while text[end] != "`" or text[end + 1 : end + 2] == "`":
                end += 2 if text[end] == "`" else 1
            out, at = text[at + 1 : end].replace("``", "`"), end + 1
        else:
            end = text.index(":", at)
            out, at = text[at:end], end
        return out

    def kind() -> tuple:
        nonlocal at
        if text.startswith("OBJECT<", at):
            at += 7
            out: dict[str, tuple] = {}
            while text[at] != ">":
                at += len(text[at:]) - len(text[at:].lstrip(", "))
                key = name()
                at += len(text[at:]) - len(text[at:].lstrip(": "))
                out[key] = kind()
            at += 1
            return "OBJECT", out
        if text.startswith("ARRAY<", at):
            at += 6
            inner = kind()
            at += 1
            return "ARRAY", inner
        m = re.compile(r"[A-Z_]+(?:\([^)]*\))?").match(text, at)
        at = m.end()
        return (m[0],)

    return kind()


Way = Callable[[Expr], Expr]


@dataclass
class Probe:
    """A field whose values need a look of their own: the way from a record to the objects that have it, its spelling,
    whether all its values are strings, and how deep it lies."""

    of: Field
    way: Way
    spelling: str
    strings: bool
    depth: int

    def values(self, doc: Expr) -> Expr:
        return _each(self.way(doc), lambda v: _field(v, [self.spelling]))


def _merge(into: Field, tree: tuple, way: Way, probes: list[Probe], depth: int = 1) -> None:
    """Takes a type seen for the objects `into` into its fields. `way` leads from a record to an array of those objects.
    Values of several shapes, and strings, which may hold lists, become probes. Below MAX_DEPTH all is text."""
    for spelling, kind in tree[1].items():
        name = SAME.get(canonical(spelling), canonical(spelling))
        f = into.inside.setdefault(name, Field())
        if spelling not in f.spelt:
            f.spelt.append(spelling)
        if depth >= MAX_DEPTH:
            f.scalar = True
            continue
        probe = Probe(f, way, spelling, kind[0] == "STRING", depth)
        below = lambda doc, p=probe: f"flatten({_each(p.values(doc), _elements)})"
        if kind[0] == "OBJECT":
            f.object = True
            _merge(f, kind, probe.values, probes, depth + 1)
        elif kind[0] == "ARRAY" and kind[1][0] == "OBJECT":
            f.list = f.object = True
            _merge(f, kind[1], below, probes, depth + 1)
        elif kind[0] == "ARRAY" and kind[1][0] != "VARIANT":
            f.list = True
            f.scalar |= kind[1][0] != "VOID"
        elif kind[0] in ("VARIANT", "STRING", "ARRAY"):
            probes.append(probe)
        else:
            f.scalar = True


#: Forms of a value: a list, an object, text that holds one of them, a blank, or a scalar.
FORMS = ("list", "object", "text list", "text object", "blank", "scalar")


def _looked_at(v: Expr) -> Expr:
    """(form, els) of a value: what it is, and its elements."""
    made = lambda form, els: f"named_struct('form', '{form}', 'els', {els})"

    def text(s: Expr) -> Expr:
        listed, opened = _as(_parsed(s, _LIST_TEXT), "array<variant>"), _parsed(s, _OBJECT_TEXT)
        return f"""case when {listed} is not null then {made("text list", listed)} when {opened} is not null then {made("text object", f"array({opened})")}
          when trim({s}) = '' then {made("blank", _NO_VARIANTS)} else {made("scalar", _NO_VARIANTS)} end"""

    listed = _as(v, "array<variant>")
    return f"case when {listed} is not null then {made('list', listed)} when {_is_object(v)} then {made('object', f'array({v})')} else {_let(_as(v, 'string'), text)} end"


def _probed(docs: DataFrame, probes: list[Probe]) -> list[Probe]:
    """One pass over the records that settles the probes, and the probes that came up in doing so."""

    def row(i: int, v: Expr) -> Expr:
        return f"named_struct('id', {i}, 'v', {v})"

    def of_one(i: int, p: Probe, objects: Expr) -> Expr:
        every = _each(objects, lambda o: row(i, _field(o, [p.spelling])))
        if not p.strings:
            return every
        # one plain text settles that a field of strings is text; a record with one need not show the others
        plain = _each(objects, lambda o: f"coalesce({_as(_field(o, [p.spelling]), 'string')} rlike {_PLAIN_TEXT}, false)", "exists")
        return f"case when {plain} then array({row(i, _ANY_SCALAR)}) else {every} end"

    def fields(mine: list[tuple[int, Probe]]) -> Expr:
        return _let(mine[0][1].way("doc"), lambda objects: f"concat({', '.join(of_one(i, p, objects) for i, p in mine)})")

    ways: dict[int, list[tuple[int, Probe]]] = {}
    for i, p in enumerate(probes):
        ways.setdefault(id(p.way), []).append((i, p))
    values = docs.selectExpr(f"explode(concat({', '.join(map(fields, ways.values()))})) as y").selectExpr("y.id", "y.v").filter(f"not {_nothing('v')}")
    seen = values.selectExpr("id", f"{_looked_at('v')} as x").selectExpr("id", "x.form", "posexplode_outer(x.els) as (pos, e)")
    seen = seen.selectExpr("id", "form", "coalesce(pos = 0, true) as first", f"coalesce(not {_nothing('e')}, false) as there", "e", f"{_is_object('e')} as is")
    wrapped = _let(f"case when not is then {_as('e', 'string')} end", lambda s: _parsed(s, _OBJECT_TEXT))
    seen = seen.selectExpr("id", "form", "first", "there", f"case when is then e else {wrapped} end as o", "not is as text")
    out = seen.groupBy("id").agg(
        F.expr("schema_of_variant_agg(o)").alias("shape"), F.count("o").alias("objects"), F.count_if(F.col("text") & F.col("o").isNotNull()).alias("strings"),
        F.count_if(F.col("there") & F.col("o").isNull()).alias("plain"), *(F.count_if((F.col("form") == f) & F.col("first")).alias(f) for f in FORMS),
    )
    more: list[Probe] = []
    for r in out.collect():
        p = probes[r["id"]]
        f = p.of
        if p.strings and (not r["text list"] + r["text object"] or r["scalar"]):
            f.scalar = True  # text, some of which may look like JSON
            continue
        f.list |= r["list"] + r["text list"] > 0
        f.scalar |= r["plain"] + r["scalar"] + r["blank"] > 0
        f.strings |= r["strings"] > 0
        if r["objects"]:
            f.object = True
            kind = parsed_type(r["shape"])
            if kind[0] == "OBJECT":
                _merge(f, kind, lambda doc, p=p: _each(f"flatten({_each(p.values(doc), _elements)})", _object), more, p.depth + 1)
    return more


def schema_of(docs: DataFrame, max_fields: int = 10_000) -> Field:
    """Merged schema over all records (record_id, doc, deep), as a tree. Each pass is one aggregate, and there are as many as
    values of mixed shapes lie within each other. More than max_fields fields (a map keyed by data, say) are an error
    rather than a truncated schema."""
    root = Field(object=True)
    docs = docs.filter("not deep")
    objects = docs.selectExpr(f"explode({elements('doc')}) as v").filter(_is_object("v"))
    got = objects.agg(F.expr("schema_of_variant_agg(v)").alias("s")).first()["s"]
    probes: list[Probe] = []
    if got and got.startswith("OBJECT<"):
        _merge(root, parsed_type(got), elements, probes)
    while probes:
        if sum(1 for _ in root.walk()) > max_fields:
            raise ValueError(f"more than {max_fields} fields in one schema")
        probes = _probed(docs, probes)
    if sum(1 for _ in root.walk()) > max_fields:
        raise ValueError(f"more than {max_fields} fields in one schema")
    return root


def merged_schema(payloads: DataFrame, column: str, max_fields: int = 10_000) -> dict[str, set[str]]:
    """Shapes seen at each path over all records: {"sections.child_sections": {"field", "list", "object"}, ...}."""
    docs = payloads.select(F.lit(0).alias("record_id"), F.try_parse_json(column).alias("doc"), F.expr(_too_deep(f"`{column}`")).alias("deep")).filter("doc is not null")
    shapes = {path: {"field"} | {s for s in ("scalar", "list", "object") if getattr(f, s)} for path, f in schema_of(docs, max_fields).walk()}
    return shapes


# --------------------------------------------------------------------------- levels


@dataclass
class Level:
    """A list in the records: its path, the fields that lead to it from its parent's elements, and what it holds."""

    path: str
    steps: list[list[str]]
    groups: list[str] | None
    holds: Field
    below: list[Level] = field(default_factory=list)

    def all(self) -> Iterator[Level]:
        for level in self.below:
            yield level
            yield from level.all()

    def values(self, parent: Expr) -> Expr:
        """Elements below an element of the parent; without any, those in the groups, numbered on."""
        at = parent
        for names in self.steps[:-1]:
            at = _object(_field(at, names))

        def found(at: Expr) -> Expr:
            flat = elements(_field(at, self.steps[-1]))
            if not self.groups:
                return flat
            inner = _each(elements(_field(at, self.groups)), lambda g: elements(_field(_object(g), self.steps[-1])))
            return _let(flat, lambda f: f"case when size({f}) > 0 then {f} else flatten({inner}) end")

        flat = _let(at, found)
        return _each(flat, _object) if self.holds.strings else flat


def levels(schema: Field) -> Level:
    """The root of the levels of a schema. A list within an object that isn't one hangs below the next list above."""
    root = Level("", [], None, schema)

    def walk(holds: Field, to: Level, path: str, steps: list[list[str]]) -> None:
        for name, f in holds.inside.items():
            way = [*steps, f.spelt]
            at = f"{path}.{name}" if path else name
            if f.is_level(name):
                groups = holds.inside.get(GROUPS.get(name, ""))
                level = Level(at, way, groups.spelt if groups else None, f)
                to.below.append(level)
                walk(f, level, at, [])
            elif f.object:
                walk(f, to, at, way)
        for name, other in GROUPS.items():  # groups without a flat list anywhere
            if other in holds.inside and name not in holds.inside and name in holds.inside[other].inside:
                inner = holds.inside[other].inside[name]
                level = Level(f"{path}.{name}" if path else name, [*steps, inner.spelt], holds.inside[other].spelt, inner)
                to.below.append(level)
                walk(inner, level, level.path, [])

    walk(schema, root, "", [])
    return root


def columns_of(level: Level) -> dict[str, list[list[str]]]:
    """Columns of a level's table: each scalar field, those of plain objects inside with their names joined, and the way
    to it. What isn't a list or object in any record is a column; a value of mixed shapes is one as well."""
    out: dict[str, list[list[str]]] = {}

    def walk(holds: Field, prefix: str, way: list[list[str]]) -> None:
        for name, f in sorted(holds.inside.items()):
            if f.is_level(name):
                continue
            if f.object:
                walk(f, f"{prefix}{name}_", [*way, f.spelt])
            if f.scalar or not f.object:
                out[f"{prefix}{name}"] = [*way, f.spelt]

    walk(level.holds, "", [])
    return out


_ROW = "array<struct<path:string,at:array<int>,v:variant>>"


def _rows(level: Level, parent: Expr, at: Expr) -> Expr:
    """Array of the rows of a level below one element of its parent, and of all levels below it; null elements take a
    place but give no row."""

    def row(v: Expr, i: Expr) -> Expr:
        return f"named_struct('path', {_literal(level.path)}, 'at', concat({at}, array({i})), 'v', {v})"

    def below(v: Expr, i: Expr) -> Expr:
        return f"concat({', '.join(_rows(low, v, f'concat({at}, array({i}))') for low in level.below)})"

    def rows(found: Expr) -> Expr:
        own = _each(_each(found, row, place=True), lambda x: f"not {_nothing(f'{x}.v')}", "filter")
        return f"concat({own}, flatten({_each(found, below, place=True)}))" if level.below else own

    return _let(level.values(parent), rows)


class Flattened:
    """The levels of a set of records and the rows of all of them."""

    def __init__(self, records: DataFrame, id_column: str = "record_id", payload_column: str = "payload"):
        self.docs = record_variants(records, id_column, payload_column)
        self.root = levels(schema_of(self.docs))
        self.levels = {level.path: level for level in self.root.all()}
        docs = self.docs.selectExpr("record_id", f"explode({elements('doc')}) as doc")
        parts = [_rows(level, "doc", "cast(array() as array<int>)") for level in self.root.below]
        rows = docs.selectExpr("record_id", f"explode({f'concat({chr(44).join(parts)})' if parts else f'cast(array() as {_ROW})'}) as x").select("record_id", "x.path", "x.at", "x.v")
        named = F.lit(None).cast("string")
        for path, element in ELEMENTS.items():
            named = F.when(F.col("path") == path, element).otherwise(named)
        place, up = F.element_at("at", -1), F.when(F.size("at") > 1, F.element_at("at", -2)).otherwise(-1)
        self.rows = rows.select("record_id", "path", F.coalesce(named, "path").alias("element"), up.alias("parent_no"), place.alias("item_no"), "at", "v")

    def key(self, own: bool = True) -> Column:
        """Surrogate key of a row, or of its parent: record, element, and the places of the row in its record."""
        record = F.col("record_id").cast("string")
        if own:
            return F.concat_ws(":", record, F.col("element"), F.array_join("at", ":"))
        out = F.lit(None).cast("string")
        for path in self.levels:
            above = max((p for p in self.levels if path.startswith(f"{p}.")), key=len, default=None)
            if above is not None:
                out = F.when(F.col("path") == path, F.concat_ws(":", record, F.lit(ELEMENTS.get(above, above)), F.array_join(F.slice("at", 1, F.size("at") - 1), ":"))).otherwise(out)
        return out

    def elements(self) -> DataFrame:
        return self.rows.select("record_id", "path", "element", "parent_no", "item_no", F.expr(_as("v", "string")).alias("value"), self.key().alias("node_key"), self.key(own=False).alias("parent_key"))

    def table(self, element: str) -> DataFrame:
        """The child table of an element or path: keys, ordinal, every field of its objects as text, and `value` for
        elements that aren't objects. Lists in it are tables of their own. Unknown elements are an empty table."""
        paths = [p for p in self.levels if element in (p, ELEMENTS.get(p))]
        own = self.rows.filter(F.col("element") == ELEMENTS.get(element, element))
        columns: dict[str, Expr] = {}
        for p in paths:
            level = self.levels[p]
            for name, way in columns_of(level).items():
                at = "v"
                for names in way[:-1]:
                    at = _object(_field(at, names))
                columns[name] = _as(_field(at, way[-1]), "string")
            if level.holds.scalar:
                columns["value"] = f"case when not {_is_object('v')} then {_as('v', 'string')} end"
        taken = {"record_id", "node_key", "parent_key", "item_no"}
        return own.select("record_id", self.key().alias("node_key"), self.key(own=False).alias("parent_key"), "item_no", *(F.expr(c).alias(n if n not in taken else f"{n}_value") for n, c in columns.items()))


def flatten_records(records: DataFrame, id_column: str = "record_id", payload_column: str = "payload") -> DataFrame:
    """All elements of all lists of all records: (record_id, path, element, parent_no, item_no, value, node_key,
    parent_key).

    After the passes for the schema, one pass and no shuffle: a record becomes one array of its elements, exploded once.
    value is the element's JSON text. node_key is the surrogate key, made of record, element and ordinals; parent_key
    that of the parent, null at the top. Records that aren't complete JSON, are null or hold no list give no row. Lists
    may be objects, strings that hold JSON, or null; nulls in lists take a position but give no row. Text fields stay
    text unless each of their values is a list or object in a string.
    """
    return Flattened(records, id_column, payload_column).elements()


def flat_table(records: DataFrame | Flattened, element: str) -> DataFrame:
    """One of the related tables, of records or of what Flattened made of them."""
    return (records if isinstance(records, Flattened) else Flattened(records)).table(element)
