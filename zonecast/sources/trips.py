"""Trip-table scans.

A trip table has the canonical columns ``pickup_datetime, PULocationID,
DOLocationID``.  Scans project exactly those columns so the parquet reader
only decodes three column chunks (``ReadSchema`` shows the pruning).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.columns import require_columns

# Canonical trip columns, zone count and monthly file naming.
REQUIRED_COLUMNS = ("pickup_datetime", "PULocationID", "DOLocationID")
NUM_TAXI_ZONES = 265
MONTH_FILE_TEMPLATE = "{taxi_type}_tripdata_{year}-{month:02d}.parquet"
FIRST_YEAR, LAST_YEAR = 2019, 2099
FIRST_MONTH = (2019, 2)          # the high-volume trip files start in Feb 2019


def read_parquet(spark: SparkSession, *paths: str, **options) -> DataFrame:
    """``spark.read.parquet`` with the Python error that callers expect for a missing path."""
    try:
        return spark.read.options(**options).parquet(*paths)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(str(exc)) from exc
        raise


def read_raw(spark: SparkSession, *paths: str,
             columns=REQUIRED_COLUMNS) -> DataFrame:
    """Scan trip parquet, check the footer schema, project the trip columns.

    No rows are filtered here.  Missing files raise ``FileNotFoundError``,
    missing columns ``ValueError`` — both at plan time, before any job.
    """
    df = read_parquet(spark, *paths)
    require_columns(df, columns, "trip file")
    return df.select(*columns)


def load(spark: SparkSession, *paths: str, num_zones: int = NUM_TAXI_ZONES) -> DataFrame:
    """``read_raw`` followed by :func:`zonecast.operators.cleaning.clean_trips`."""
    from zonecast.operators.cleaning import clean_trips
    return clean_trips(read_raw(spark, *paths), num_zones=num_zones)


def check_month(year: int, month: int, first: tuple[int, int] | None = FIRST_MONTH) -> None:
    """``ValueError`` unless year and month are whole numbers that name a month which can exist."""
    for v, name in ((year, "year"), (month, "month")):
        if isinstance(v, bool) or not isinstance(v, int):
            raise ValueError(f"{name} must be an integer")
    if first is not None and not FIRST_YEAR <= year <= LAST_YEAR:
        raise ValueError(f"year must be in {FIRST_YEAR}..{LAST_YEAR}, got {year}")
    if not 1 <= month <= 12:
        raise ValueError(f"month must be in 1..12, got {month}")
    if first is not None and (year, month) < first:
        raise ValueError("trip files start in February 2019")


def month_path(base_dir: str, year: int, month: int, taxi_type: str = "fhvhv") -> str:
    check_month(year, month)
    return f"{base_dir.rstrip('/')}/" + MONTH_FILE_TEMPLATE.format(
        taxi_type=taxi_type, year=year, month=month)


def read_months(spark: SparkSession, base_dir: str, months, *,
                taxi_type: str = "fhvhv", num_zones: int = NUM_TAXI_ZONES) -> DataFrame:
    """Load and clean many monthly files in one scan (one plan, one job)."""
    paths = [month_path(base_dir, y, m, taxi_type) for y, m in months]
    if not paths:
        raise ValueError("months must not be empty")
    return load(spark, *paths, num_zones=num_zones)


def trips_from_events(events: DataFrame) -> DataFrame:
    """Canonical trip view over the driver's ``events`` table.

    ``ts`` is the pickup time, ``user_id`` the pickup zone and the integer
    ``k`` of the ``props`` JSON the drop-off zone.
    """
    require_columns(events, ("ts", "user_id", "props"), "events")
    return events.select(
        F.col("ts").alias("pickup_datetime"),
        F.col("user_id").alias("PULocationID"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("DOLocationID"),
    )


def read_events_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(read_parquet(spark, f"{sf_dir}/events.parquet"))


def schema_profile(df: DataFrame, *, with_counts: bool = False) -> DataFrame:
    """``(ordinal, name, type)`` per column, from the footer schema (no scan).

    ``with_counts`` adds the table's ``n_rows`` and each column's
    ``n_nulls`` from one aggregate pass over the data.
    """
    fields = df.schema.fields
    meta = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("name"),
                              F.lit(f.dataType.simpleString()).alias("type"))
                     for i, f in enumerate(fields)])
    if not with_counts:
        return df.sparkSession.range(1).select(F.explode(meta).alias("m")).select("m.*")
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"),
                    *[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_n{i}") for i, f in enumerate(fields)])
    nulls = F.array(*[F.col(f"_n{i}") for i in range(len(fields))])
    return counts.select("n_rows", F.explode(F.arrays_zip(meta, nulls)).alias("z")) \
                 .select("z.0.*", "n_rows", F.col("z.1").alias("n_nulls"))


def footer_stats(spark: SparkSession, path: str) -> DataFrame:
    """``column, type, n_rows, n_nulls, min_value, max_value`` of a Parquet table from its footers alone.

    The counts, and the bounds of whole-number and date columns, are pushed
    into the Parquet reader as aggregates, so no page is decoded; other types
    have null bounds, as their footers may hold cut or unordered ones.  The
    push-down needs the reader's newer interface, which is chosen in a session
    of its own; the caller's settings stay as they are.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    df = read_parquet(own, path)
    bounded = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(df.schema.fields):
        if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            aggregates.append(F.count(F.col(f"`{f.name}`")).alias(f"n{i}"))
        if isinstance(f.dataType, bounded):
            aggregates += [F.min(F.col(f"`{f.name}`")).alias(f"lo{i}"), F.max(F.col(f"`{f.name}`")).alias(f"hi{i}")]
    one = df.agg(*aggregates)

    def text(name):
        return F.col(name).cast("string") if name in one.columns else F.lit(None).cast("string")
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col("n").alias("n_rows"),
                     ((F.col("n") - F.col(f"n{i}")) if f"n{i}" in one.columns else F.lit(None).cast("bigint")).alias("n_nulls"),
                     text(f"lo{i}").alias("min_value"), text(f"hi{i}").alias("max_value")) for i, f in enumerate(df.schema.fields)]
    return one.select(F.inline(F.array(*rows)))
