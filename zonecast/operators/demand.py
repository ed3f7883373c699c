"""Hourly demand: count trips per (zone, hour), optionally on a full grid.

Plan shape (see ``.explain``): the count is a two-phase hash aggregate, so a
zone holding a third of all trips is already combined map-side before the
shuffle.  The grid is generated per zone on the executors between the global
first and last step (two scalars from one small aggregate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.columns import require_columns
from zonecast.functions.time import floor_time, hour_series, ntz_literal
from zonecast.session import checkpoint_dir, shared_path


def aggregate(trips: DataFrame, *, fill_missing_hours: bool = False,
              key: str = "PULocationID", ts: str = "pickup_datetime",
              grain: str = "hour", out_key: str = "zone_id",
              out_time: str = "hour", out_count: str = "demand",
              materialize: str = "parquet") -> DataFrame:
    """Count rows per (key, floored time) → ``(zone_id, hour, demand)``.

    Rows with a null key or time are not counted.  With
    ``fill_missing_hours=True`` every observed zone gets every step between
    the *global* first and last step, missing cells count 0.  That path runs
    two small jobs up front: writing the panel and the fetch of its bounds
    (see :func:`fill_grid`; ``materialize="none"`` skips the writing, and
    each branch then re-reads the input).
    """
    require_columns(trips, (key, ts), "trip table")
    panel = (trips.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
                  .groupBy(F.col(key).cast("bigint").alias(out_key),
                           floor_time(ts, grain).alias(out_time))
                  .agg(F.count(F.lit(1)).alias(out_count)))
    if fill_missing_hours:
        panel = fill_grid(panel, key=out_key, time=out_time, value=out_count, grain=grain,
                          materialize=materialize)
    return panel


# A grid partition holds about this many (key, step) cells; the grid is
# never spread over fewer partitions than the cluster has cores.
GRID_ROWS_PER_PARTITION = 1_000_000
_STEP_SECONDS = {"hour": 3600, "day": 86400, "minute": 60}


def grid_stats(panel: DataFrame, *, key: str = "zone_id", time: str = "hour"):
    """``(first, last, n_keys)`` of a panel in one small aggregate (a driver scalar row)."""
    r = panel.agg(F.min(time).alias("lo"), F.max(time).alias("hi"),
                  F.count_distinct(key).alias("n")).first()
    return r["lo"], r["hi"], r["n"]


def grid(panel: DataFrame, *, key: str = "zone_id", time: str = "hour",
         grain: str = "hour", stats=None) -> DataFrame:
    """Observed keys × every step from the global min to max of ``time``.

    The keys are hash-partitioned into a count sized from the grid's cell
    count (keys × steps): the grid grows hundreds of times after that
    shuffle, so letting adaptive execution coalesce it by its (tiny) input
    size would generate the whole grid in a few tasks.  Each key's steps are
    generated on the executor that owns the key.
    """
    lo, hi, n_keys = stats or grid_stats(panel, key=key, time=time)
    spark = panel.sparkSession
    key_type = panel.schema[key].dataType
    if lo is None:
        return spark.createDataFrame([], T.StructType([T.StructField(key, key_type),
                                                       T.StructField(time, panel.schema[time].dataType)]))
    steps = int((hi - lo).total_seconds() // _STEP_SECONDS[grain]) + 1
    parts = max(spark.sparkContext.defaultParallelism,
                -(-n_keys * steps // GRID_ROWS_PER_PARTITION))
    # the distinct combines map-side, so one row per key and task moves; the
    # by-number shuffle after it is not coalesced by adaptive execution
    keys = panel.select(key).distinct().repartition(parts, key)
    return keys.select(key, F.explode(hour_series(ntz_literal(lo), ntz_literal(hi), grain)).alias(time))


def materialized(df: DataFrame, how: str) -> DataFrame:
    """Cut the lineage of a frame that several branches of one plan read.

    ``"parquet"`` writes it once as a table below the shared
    ``spark.checkpoint.dir`` (removed when the session ends): it survives
    executor loss, and every reader gets column pruning and pushed filters.
    ``"checkpoint"`` does the same with Spark's own checkpoint files, which
    are read whole; ``"none"`` keeps the plan lazy, so each branch recomputes
    it from the source.
    """
    if how == "none":
        return df
    if how == "parquet":
        path = shared_path(df.sparkSession, "zonecast-frame")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    if how == "checkpoint":
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    raise ValueError(f"materialize must be 'parquet', 'checkpoint' or 'none', got {how!r}")


def fill_grid(panel: DataFrame, *, key: str = "zone_id", time: str = "hour",
              value: str = "demand", grain: str = "hour",
              materialize: str = "parquet") -> DataFrame:
    """Left-join a panel onto its complete grid; missing cells get 0.

    The panel feeds the bounds, the keys and the join side.  Materialising it
    once means the raw trips are scanned once, not three times.  The grid is
    hash-partitioned by key, the panel side of the join is shuffled to the
    same partitioning, so the join and any following per-key window add no
    grid-sized shuffle.
    """
    require_columns(panel, (key, time, value), "demand panel")
    panel = materialized(panel, materialize)
    g = grid(panel, key=key, time=time, grain=grain)
    return (g.join(panel, [key, time], "left")
             .select(key, time, F.coalesce(F.col(value), F.lit(0)).cast("bigint").alias(value)))


def hour_bounds(panel: DataFrame, time: str = "hour") -> DataFrame:
    """One row: first and last step and the number of distinct steps."""
    return panel.agg(F.min(time).alias("first_hour"), F.max(time).alias("last_hour"),
                     F.count_distinct(time).alias("n_hours"))
