"""Calendar features: hour of day, Monday-based weekday, weekend and holiday flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.columns import require_columns
from zonecast.functions.holidays import holiday_dates, is_holiday

CALENDAR_COLUMNS = ("hour_of_day", "day_of_week", "is_weekend", "is_holiday")


def _strict_time(df: DataFrame, time: str):
    dt = df.schema[time].dataType
    if isinstance(dt, T.TimestampNTZType):
        parsed = F.col(time)
    elif isinstance(dt, (T.TimestampType, T.DateType)):
        parsed = F.col(time).cast("timestamp_ntz")
    elif isinstance(dt, T.StringType):
        parsed = F.try_to_timestamp(F.col(time)).cast("timestamp_ntz")
    else:
        raise ValueError(f"column {time!r} must be a timestamp, date or text, got {dt.simpleString()}")
    # A null or unparseable time fails the job that computes the features,
    # in the same pass, instead of a separate validation scan.
    return F.when(parsed.isNull(),
                  F.raise_error(F.lit(f"column {time!r} has null or unparseable values"))
                  ).otherwise(parsed)


def add_calendar_features(df: DataFrame, holidays=None, *, time: str = "hour") -> DataFrame:
    """Append ``hour_of_day, day_of_week, is_weekend, is_holiday`` (INT).

    ``holidays``: None (federal calendar), ``"federal"``/``"state"``, an
    iterable of date-likes, or a DataFrame of dates.  The built-in calendars
    are rules over the date itself - any year, no join.  Other dates are
    joined without a hint, so they are broadcast only if Spark finds them small.
    """
    require_columns(df, (time,), "DataFrame")
    base = df.withColumn(time, _strict_time(df, time))
    day = F.to_date(time)
    if holidays is None or isinstance(holidays, str):
        flag = is_holiday(day, holidays or "federal")
    else:
        hol = holiday_dates(df.sparkSession, holidays).withColumnRenamed("holiday_date", "_hdate")
        base = base.withColumn("_hday", day)
        base = base.join(hol, F.col("_hday") == F.col("_hdate"), "left")
        flag = F.col("_hdate").isNotNull()
    others = [c for c in df.columns if c not in CALENDAR_COLUMNS]
    return base.select(
        *others,
        F.hour(time).alias("hour_of_day"),
        F.weekday(time).alias("day_of_week"),
        (F.weekday(time) >= 5).cast("int").alias("is_weekend"),
        flag.cast("int").alias("is_holiday"),
    )
