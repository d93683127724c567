"""Document, cache and configuration files: scans and atomic sinks."""

from __future__ import annotations

import os
import re
import time
from pathlib import Path
from urllib import parse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CHILD = "array<struct<section_id:string,title:string,base_path:string,group:string>>"
SECTION = (
    "struct<section_id:string,base_path:string,url:string,title:string,heading:string,description:string,text:string,attachments:array<struct<title:string,url:string,content_type:string>>,"
    f"char_count:bigint,word_count:bigint,is_contents_page:boolean,child_sections:{_CHILD},cross_references:array<struct<href:string,text:string>>,first_published_at:string,"
    "public_updated_at:string,updated_at:string,withdrawn:boolean,content_id:string,error:string>"
)
DOCUMENT = (
    "schema string, schema_version int, format string, manual struct<slug:string,format:string,title:string,base_path:string,url:string,description:string,organisations:array<string>,"
    "first_published_at:string,public_updated_at:string,withdrawn:boolean>, crawl struct<source:string,crawled_at:string,section_count_reported:bigint,page_count_reported:bigint>, "
    f"sections array<{SECTION}>, pages array<{SECTION}>"
)


def read_documents(spark: SparkSession, path: str, slugs: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Crawled documents of a folder, one row a file, with `slug` (the manual's, else the file name) and `items`.

    Files that begin with an underscore, and others than .json, are skipped; broken files come with `_corrupt_record`.
    Slugs asked for match in any case, with or without `.json`, and prune files before they are read; so does a limit,
    which takes the first of them by name.
    """
    reader = spark.read.schema(f"{DOCUMENT}, _corrupt_record string").option("multiLine", True).option("pathGlobFilter", "*.json")
    docs = reader.json(path).withColumn("file", F.col("_metadata.file_name"))
    if slugs:
        docs = docs.filter(F.lower(F.regexp_replace("file", r"\.json$", "")).isin(*[s.lower().removesuffix(".json") for s in slugs]))
    if limit is not None:
        names = sorted(f.rsplit("/", 1)[-1] for f in docs.inputFiles())
        wanted = {s.lower().removesuffix(".json") for s in slugs} if slugs else None
        docs = docs.filter(F.col("file").isin(*[parse.unquote(n) for n in names if wanted is None or parse.unquote(n).lower().removesuffix(".json") in wanted][:limit]))
    return docs.withColumn("slug", F.coalesce("manual.slug", F.regexp_replace("file", r"\.json$", ""))).withColumn("items", F.coalesce("sections", "pages"))


def document_sections(docs: DataFrame) -> DataFrame:
    """One row per section or page, with slug and position in the file."""
    return docs.select("slug", F.posexplode("items").alias("position", "s")).select("slug", "position", "s.*")


def write_documents(sections: DataFrame, path: str, force: bool = False, lines: bool = False) -> bool:
    """Writes (slug, sections) documents as JSON, one folder a slug; True if it wrote any. Documents whose folder is there
    are skipped, unless forced.

    Folders are written aside and put in their places when the job commits, so that readers see the whole of a document,
    the old or the new one. A document's sections are one array, as in the format; with `lines` each section is a line
    with its position instead, for manuals too large to be one value.
    """
    spark = sections.sparkSession
    fields = [c for c in sections.columns if c not in ("slug", "position")]
    order = F.col("position") if "position" in sections.columns else F.coalesce("section_id", F.lit(""))
    if not force and (there := _folders(spark, path)):
        sections = sections.join(spark.createDataFrame([(s,) for s in there], "slug string"), "slug", "left_anti")
    if sections.isEmpty():
        return False
    if lines:
        docs = sections.select("slug", order.alias("position"), *fields)
    else:
        docs = sections.groupBy("slug").agg(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("_o"), F.struct(*fields).alias("s")))), lambda x: x["s"]).alias("sections"))
    docs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slug").json(path)
    return True


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Slugs that have a folder under the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return [parse.unquote(n.removeprefix("slug=")) for n in names if n.startswith("slug=")]


def read_cache(spark: SparkSession, path: str, result: str = "string") -> DataFrame:
    """(key, result, seq) of an append-only cache of JSON lines. Broken lines, as the cut tail of a crashed writer
    leaves them, are skipped. seq orders the records: by the time of their append, which append_cache writes with them,
    then by file, by block of the file, and by line within it."""
    at = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select("value", at.alias("at"))
    parsed = F.from_json("value", f"key string, result {result}, written bigint", {"mode": "PERMISSIVE"})
    rows = lines.filter(F.try_parse_json("value").isNotNull()).select(parsed.alias("x"), "at")
    return rows.filter("x.key is not null").select("x.key", "x.result", F.struct(F.coalesce("x.written", F.lit(0)).alias("written"), "at").alias("seq"))


def latest(cache: DataFrame) -> DataFrame:
    """The last record of each key."""
    return cache.groupBy("key").agg(F.max_by("result", "seq").alias("result"))


def append_cache(rows: DataFrame, path: str) -> None:
    """Adds records with the time of this call, in nanoseconds, so that they win over all that are there, whatever the
    names of the files."""
    rows.select("key", "result", F.lit(time.time_ns()).alias("written")).write.mode("append").json(path)


_FENCE = r"(?s)^\s*```[A-Za-z]*\s*(.*?)\s*```\s*$"


def salvage_json(text: Column) -> Column:
    """The JSON in a model's answer: without thoughts and code fence if that parses, else from the first opening to the
    last closing brace if that does, else null."""
    bare = F.regexp_replace(text, r"(?s)<think>.*?</think>", "")
    bare = F.regexp_replace(F.regexp_replace(bare, _FENCE, "$1"), r"^\s+|\s+$", "")
    inner = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    return F.when(F.try_parse_json(bare).isNotNull(), bare).when(F.try_parse_json(inner).isNotNull(), inner)


def load_env(path: str) -> dict[str, str]:
    """KEY=VALUE lines of a file, quotes and comments off, without what the environment already has; it is set there."""
    found: dict[str, str] = {}
    for line in Path(path).read_text().splitlines() if os.path.exists(path) else ():
        if m := re.match(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", line):
            found[m[1]] = m[2][1:-1] if len(m[2]) > 1 and m[2][0] == m[2][-1] and m[2][0] in "'\"" else m[2]
    for k, v in found.items():
        os.environ.setdefault(k, v)
    return found
