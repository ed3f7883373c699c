"""Trips laid out by month: one folder a month, rows in order of time inside its files.

A reader names the months it wants and only their folders are listed, so the
size of the store does not matter; inside a month the time order gives row
groups narrow ranges of time, so a pushed time filter skips most of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.columns import require_columns
from zonecast.functions.time import ntz_literal
from zonecast.sources.trips import FIRST_MONTH, NUM_TAXI_ZONES, REQUIRED_COLUMNS, check_month, read_parquet

ROWS_PER_FILE = 4_000_000


def write_months(trips: DataFrame, base_dir: str, *, ts: str = "pickup_datetime",
                 rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``trips`` below ``base_dir`` as ``year=Y/month=M`` folders of sorted files.

    A month's files follow from its row count (one small aggregate), and its
    rows are dealt to them by hash, so a month that holds most of the table
    is written by many tasks and no month by more than it needs.  Months that
    are in ``trips`` are replaced, others stay.  Rows without a time go to a
    folder of their own, which no month reads.  Columns named ``year`` or
    ``month`` are refused, the folder names would hide them.
    """
    require_columns(trips, (ts,), "trip table")
    if {"year", "month"} & {c.lower() for c in trips.columns}:
        raise ValueError("columns year and month are the store's own")
    rows = trips.withColumns({"year": F.year(ts), "month": F.month(ts)})
    files = rows.groupBy("year", "month").agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    files = files.select(F.col("year").alias("_y"), F.col("month").alias("_m"), "_files")
    dealt = rows.join(files, rows["year"].eqNullSafe(files["_y"]) & rows["month"].eqNullSafe(files["_m"]))
    dealt = dealt.withColumn("_file", F.pmod(F.xxhash64(*trips.columns), F.col("_files")))
    (dealt.repartition("year", "month", "_file").sortWithinPartitions("year", "month", "_file", ts)
          .select(*trips.columns, "year", "month")
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(base_dir))


def stored_months(spark: SparkSession, base_dir: str) -> DataFrame:
    """``(year, month)`` of the folders of a store; the files are not opened."""
    df = read_parquet(spark, base_dir)
    require_columns(df, ("year", "month"), "month store")
    return df.select("year", "month").distinct().where(F.col("year").isNotNull())


def read_month_store(spark: SparkSession, base_dir: str, months, *, start: dt.datetime | None = None,
                     end: dt.datetime | None = None, ts: str = "pickup_datetime", columns=REQUIRED_COLUMNS,
                     first: tuple[int, int] | None = FIRST_MONTH) -> DataFrame:
    """The rows of ``months`` (pairs of year and month) with ``start <= ts < end``, in one scan.

    Only the folders of the wanted months are listed, and the time bounds are
    pushed to the Parquet reader.  A month that is not stored raises
    ``FileNotFoundError``, a column that is missing ``ValueError``.  ``first``
    is the earliest month that can exist.
    """
    wanted = list(dict.fromkeys((y, m) for y, m in months))
    if not wanted:
        raise ValueError("months must not be empty")
    for y, m in wanted:
        check_month(y, m, first)
    base = base_dir.rstrip("/")
    paths = [f"{base}/year={y}/month={m}" for y, m in wanted]
    df = read_parquet(spark, *paths, basePath=base)
    require_columns(df, columns, "month store")
    bound = ntz_literal if isinstance(df.schema[ts].dataType, T.TimestampNTZType) else F.lit
    if start is not None:
        df = df.where(F.col(ts) >= bound(start))
    if end is not None:
        df = df.where(F.col(ts) < bound(end))
    return df.select(*columns)


def months_between(start: dt.datetime, end: dt.datetime) -> list[tuple[int, int]]:
    """The calendar months that hold a moment of ``start <= t < end``."""
    last = (end - dt.timedelta(microseconds=1)) if end > start else start
    count = (last.year - start.year) * 12 + last.month - start.month + 1
    return [((start.year * 12 + start.month - 1 + i) // 12, (start.month - 1 + i) % 12 + 1) for i in range(count)] if end > start else []


def read_month_range(spark: SparkSession, base_dir: str, start: dt.datetime, end: dt.datetime, *,
                     num_zones: int = NUM_TAXI_ZONES) -> DataFrame:
    """Cleaned trips with ``start <= pickup < end``: only the months of the range are read."""
    from zonecast.operators.cleaning import clean_trips
    months = months_between(start, end)
    if not months:
        raise ValueError("end must be after start")
    return clean_trips(read_month_store(spark, base_dir, months, start=start, end=end), num_zones=num_zones)
