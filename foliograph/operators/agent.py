"""A question loop over the retrieval tools. The model is a function from messages to a reply; Spark does the tools."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.operators import retrieval
from foliograph.operators.models import Embedder
from foliograph.operators.search import search_both

MAX_ROUNDS, MAX_RESULT, MAX_CONTEXT, MAX_SHOWN = 8, 20_000, 4_000, 400


@dataclass
class Reply:
    """What a model says: text, or calls of tools as (name, arguments)."""

    text: str = ""
    calls: list[tuple[str, dict[str, Any]]] = field(default_factory=list)


def to_json(df: DataFrame, limit: int = retrieval.MAX_ROWS) -> str:
    """Rows as a JSON list, at most `limit` of them, limited in the plan."""
    return "[" + ",".join(df.limit(limit).toJSON().collect()) + "]"


Tool = Callable[..., "DataFrame | dict[str, DataFrame]"]

#: What a model is told of the tools: name, purpose, and arguments with their JSON types.
DESCRIPTORS: list[dict[str, Any]] = [
    {"name": name, "description": text, "parameters": {"type": "object", "properties": {k: {"type": t} for k, t in arguments.items()}, "required": required}}
    for name, text, arguments, required in (
        ("semantic_search", "Sections, entities or both that are nearest in meaning to a query. Use it first.", {"query": "string", "kind": "string", "top": "integer"}, ["query"]),
        ("expand", "What stands in sections, or around entities: relations with their evidence, parents, pages to cite.", {"section_ids": "string", "entity_keys": "string"}, []),
        ("read_sections", "Whole texts of sections by id, and which ids aren't there.", {"section_ids": "string"}, ["section_ids"]),
        ("centrality", "Neighbours of an entity by the strength of its relations.", {"entity_key": "string"}, ["entity_key"]),
        ("sql", "A read-only query over the tables, at most a hundred rows.", {"query": "string"}, ["query"]),
    )
]


def tools(spark: SparkSession, tables: dict[str, DataFrame], search: Callable[[str, str, int], DataFrame] | None = None, embedder: Embedder | None = None) -> dict[str, Tool]:
    """The five tools over tables `sections`, `entities`, `mentions`, `edges`, `children` and `documents`, as far as they
    are there. Search needs an embedder and the tables of search.search, or a function of its own."""

    def keyed(column: str, values: list[str]) -> DataFrame:
        return spark.createDataFrame([(v,) for v in values], f"{column} string")

    def expand(section_ids: str = "", entity_keys: str = "") -> dict[str, DataFrame]:
        pages, keys = retrieval.coerce_ids(section_ids), retrieval.coerce_ids(entity_keys)
        if not pages and not keys:
            raise ValueError("section_ids or entity_keys are needed")
        out: dict[str, DataFrame] = {}
        if pages:
            out["sections"] = retrieval.expand_sections(keyed("node_id", pages), tables["sections"], tables["children"], tables["mentions"], tables["entities"], tables["edges"])
        if keys:
            out["entities"] = retrieval.expand_entities(keyed("key", keys), tables["edges"], tables["mentions"], tables["sections"], tables["documents"])
        return out

    def read_sections(section_ids: str) -> DataFrame:
        ids = retrieval.coerce_ids(section_ids)
        if not ids:
            raise ValueError("section_ids are needed")
        return retrieval.read_sections(tables["sections"], keyed("node_id", ids))

    def centrality(entity_key: str) -> DataFrame:
        return retrieval.ego_network(tables["edges"], tables["entities"], entity_key).orderBy(F.desc("mentions"), "other").limit(retrieval.RELS_PER_NODE)

    def sql(query: str) -> DataFrame:
        return retrieval.guarded_sql(spark, query, tables)

    out: dict[str, Tool] = {"expand": expand, "read_sections": read_sections, "centrality": centrality, "sql": sql}
    if search is not None:
        out["semantic_search"] = lambda query, kind="both", top=5: search(query, kind, max(1, min(10, int(top))))
    elif embedder is not None:
        out["semantic_search"] = lambda query, kind="both", top=5: search_both(kind, query, tables, embedder, int(top))
    return out


def to_text(result: DataFrame | dict[str, DataFrame]) -> str:
    """A tool's result as JSON: a list of rows, or lists by name."""
    if isinstance(result, dict):
        return "{" + ",".join(f"{json.dumps(k)}:{to_json(v)}" for k, v in result.items()) + "}"
    return to_json(result)


def answer(question: str, model: Callable[[list[dict[str, str]]], Reply], available: dict[str, Tool], tell: Callable[[dict[str, Any]], None] = lambda event: None) -> dict[str, Any]:
    """Runs the loop: the model asks for tools, at most MAX_ROUNDS times, then answers. A tool's error is its result.
    `tell` is called with each call and result as it happens."""
    messages: list[dict[str, str]] = [{"role": "user", "content": question}]
    reply = Reply()
    for _ in range(MAX_ROUNDS):
        reply = model(messages)
        if not reply.calls:
            break
        for name, arguments in reply.calls:
            tell({"event": "call", "name": name, "arguments": arguments})
            try:
                result = to_text(available[name](**arguments))
            except Exception as e:  # noqa: BLE001
                result = json.dumps({"error": f"{type(e).__name__}: {e}"[:MAX_CONTEXT]})
            messages.append({"role": "tool", "name": name, "content": result[:MAX_RESULT]})
            tell({"event": "tool", "name": name, "content": result[:MAX_SHOWN]})
    try:
        final = json.loads(reply.text)
    except ValueError:
        final = None
    if not isinstance(final, dict) or "answer" not in final:
        final = {"answer": reply.text}
    return {"answer": final["answer"], "sources": final.get("sources", []), "graph_refs": final.get("graph_refs", []), "messages": messages}
