"""Trip cleaning: coerce time, drop incomplete rows, cast ids, keep valid zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.columns import require_columns
from zonecast.sources.trips import NUM_TAXI_ZONES, REQUIRED_COLUMNS


def _coerce_time(df: DataFrame, c: str) -> DataFrame:
    dt = df.schema[c].dataType
    if isinstance(dt, T.TimestampNTZType):
        return df
    if isinstance(dt, (T.TimestampType, T.DateType)):
        return df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    # text or anything else: unparseable values become null and are dropped below
    return df.withColumn(c, F.try_to_timestamp(F.col(c).cast("string")).cast("timestamp_ntz"))


def _cast_id(df: DataFrame, c: str) -> DataFrame:
    dt = df.schema[c].dataType
    if isinstance(dt, T.LongType):
        return df
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        # truncates toward zero (3.7 -> 3); NaN has already been dropped
        return df.withColumn(c, F.col(c).try_cast("bigint"))
    return df.withColumn(c, F.col(c).cast("bigint"))


def clean_trips(df: DataFrame, *, num_zones: int = NUM_TAXI_ZONES,
                columns=REQUIRED_COLUMNS) -> DataFrame:
    """Clean a trip table; extra columns flow through.

    Order of steps is part of the contract: time coercion, null/NaN drop over
    the three columns, id cast (truncating), then the inclusive range
    ``1 <= id <= num_zones`` on both ids.  The predicates reach the parquet
    scan as pushed filters.
    """
    if isinstance(num_zones, bool) or not isinstance(num_zones, int) or num_zones <= 0:
        raise ValueError(f"num_zones must be a positive integer, got {num_zones!r}")
    require_columns(df, columns, "trip table")
    ts, pu, do = columns
    out = _coerce_time(df, ts).dropna(how="any", subset=list(columns))
    out = _cast_id(_cast_id(out, pu), do)
    return out.where(F.col(pu).between(1, num_zones) & F.col(do).between(1, num_zones))


def clean_report(df: DataFrame, *, num_zones: int = NUM_TAXI_ZONES,
                 columns=REQUIRED_COLUMNS) -> DataFrame:
    """One-row audit of what :func:`clean_trips` would remove, in one pass."""
    require_columns(df, columns, "trip table")
    ts, pu, do = columns
    any_null = F.col(ts).isNull() | F.col(pu).isNull() | F.col(do).isNull()
    pu_bad = ~F.col(pu).between(1, num_zones)
    do_bad = ~F.col(do).between(1, num_zones)
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(any_null).alias("rows_null"),
        F.count_if(pu_bad).alias("pu_out_of_range"),
        F.count_if(do_bad).alias("do_out_of_range"),
        F.count_if(~any_null & ~pu_bad & ~do_bad).alias("rows_out"),
    )
