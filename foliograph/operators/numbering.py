"""Numbers over rows in a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliograph.session import cut


def global_numbers(df: DataFrame, order: list[Column], column: str) -> DataFrame:
    """df with `column`, its rows numbered from 0 in a total order, without one task that sees them all.

    The rows are sorted by ranges and kept; numbers run within a range, and each range starts where the ones before
    it end. The driver gets one count per range.
    """
    ranges = cut(df.orderBy(*order).withColumn("_range", F.spark_partition_id()))
    counts = sorted((r[0], r[1]) for r in ranges.groupBy("_range").count().collect())
    starts, at = [], 0
    for name, n in counts:
        starts += [F.lit(name), F.lit(at).cast("bigint")]
        at += n
    number = F.row_number().over(W.partitionBy("_range").orderBy(*order)) - 1
    first = F.element_at(F.create_map(*starts), F.col("_range")) if starts else F.lit(0).cast("bigint")
    return ranges.withColumn(column, first + number).drop("_range")
