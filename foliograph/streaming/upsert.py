"""Incremental loading: a stream of loads folded into snapshot tables, each batch once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.operators import folds
from foliograph.session import cut
from foliograph.sources.graph_store import GraphStore

LOAD = "entity_id bigint, slug string, key string, name string, type string, definition string, aliases array<string>, section_ids array<string>, salience string, mentions bigint, created_from string, loaded_at timestamp"


def load_stream(spark: SparkSession, path: str, schema: str = LOAD, files_per_batch: int = 1) -> DataFrame:
    """Loads as files arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def fold_batch(store: GraphStore, fold: Callable[[DataFrame], DataFrame] = folds.entity_upsert, table: str = "loads", folded: str = "folded", key: str = "key", buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that keeps the distinct loads and their fold in the store.

    Both are kept in buckets by a hash of the key, and a batch reads, folds and writes only the buckets its keys fall
    into. A batch that is delivered again adds nothing, as rows are kept by their id; so the fold is the same whatever
    the batches, repeated ones included. An empty batch changes nothing. A store keeps the number of buckets it began
    with.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.dropDuplicates(["entity_id"]).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"))
        touched = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most `buckets`
        if not touched:
            return
        old = store.load(table, touched)
        if old is not None:
            rest = fresh.join(old.select("entity_id"), "entity_id", "left_anti")
            fresh = old.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")).unionByName(rest)
        fresh = cut(fresh)
        done = fold(fresh.drop("bucket")).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"))
        store.save({}, {table: (fresh, "bucket"), folded: (done, "bucket")})

    return sink


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "1 day", late: str = "30 days") -> DataFrame:
    """Counts per window and key of a stream, with a watermark that still takes rows that arrive late."""
    at = F.col(time).cast("timestamp")
    return events.withColumn("_at", at).withWatermark("_at", late).groupBy(F.window("_at", width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")


def deduplicated(events: DataFrame, id_column: str, time: str, late: str = "30 days") -> DataFrame:
    """Rows of a stream once per id, as long as a repetition may arrive."""
    return events.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", late).dropDuplicatesWithinWatermark([id_column]).drop("_at")
