"""Sinks that keep an order: globally sorted folders, and bucketed, sorted tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.functions.columns import require_columns


def write_sorted(df: DataFrame, path: str, keys) -> None:
    """Write ``df`` as Parquet so that its files, by name, and the rows in them follow ``keys``.

    Rows are range-partitioned and sorted within partitions; no task sees
    more than its range.  Rows that are equal in all keys stay together in
    any order.
    """
    keys = list(keys)
    require_columns(df, keys, "DataFrame")
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def read_positions(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The rows of a folder with their 0-based place: files in order of name, rows as they are stored.

    A file's offset is the number of rows in the files before it (one row per
    file goes through the running sum), the place inside is the reader's own.
    """
    rows = spark.read.parquet(path)
    if position in rows.columns:
        raise ValueError(f"there is a column {position!r} already")
    at = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = at.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return at.join(offsets, "_file").select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_offset") + F.col("_row")).alias(position))


def write_bucketed(df: DataFrame, path: str, keys, buckets: int, sort_by=(), name: str | None = None) -> str:
    """Save ``df`` below ``path`` as a table bucketed by ``keys``, sorted inside by ``keys`` and ``sort_by``; returns its name.

    Tables bucketed alike are joined and grouped by ``keys`` without a
    shuffle.  Rows go to their bucket's task first, so a bucket is one file.
    The table is external: dropping it leaves the files.
    """
    keys, order = list(keys), [*keys, *sort_by]
    require_columns(df, order, "DataFrame")
    if isinstance(buckets, bool) or not isinstance(buckets, int) or buckets < 1:
        raise ValueError(f"buckets must be a positive integer, got {buckets!r}")
    name = name or f"zonecast_{uuid.uuid4().hex}"
    (df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*order).saveAsTable(name))
    return name
