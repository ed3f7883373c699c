"""Hourly demand over a stream of trips.

The batch operator :func:`zonecast.operators.demand.aggregate` re-expressed
for Structured Streaming: the same cleaning and count per (zone, hour), with
an event-time watermark so the state of closed hours is dropped and each
(zone, hour) row is emitted once, when the watermark passes the hour.
Watermarks need session-zone ``TIMESTAMP``; with the session pinned to UTC
the cast from ``TIMESTAMP_NTZ`` keeps the wall-clock value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonecast.functions.columns import require_columns
from zonecast.operators.cleaning import clean_trips
from zonecast.session import configure
from zonecast.sources.trips import NUM_TAXI_ZONES, REQUIRED_COLUMNS


def hourly_demand_stream(trips: DataFrame, *, watermark: str = "1 hour",
                         num_zones: int | None = NUM_TAXI_ZONES, key: str = "PULocationID",
                         ts: str = "pickup_datetime") -> DataFrame:
    """Streaming ``(zone_id, hour, demand)``; pass ``num_zones=None`` to skip cleaning.

    Cleaning needs all of the trip columns; a stream without one is refused.
    """
    require_columns(trips, (key, ts) if num_zones is None else (key, ts, *REQUIRED_COLUMNS), "trip stream")
    configure(trips.sparkSession)
    src = trips if num_zones is None else clean_trips(trips, num_zones=num_zones)
    src = src.where(F.col(key).isNotNull() & F.col(ts).isNotNull()) \
             .withColumn("_event_ts", F.col(ts).cast("timestamp")) \
             .withWatermark("_event_ts", watermark)
    counted = src.groupBy(F.col(key).cast("bigint").alias("zone_id"),
                          F.window("_event_ts", "1 hour").alias("_w")) \
                 .agg(F.count(F.lit(1)).alias("demand"))
    return counted.select("zone_id", F.col("_w.start").cast("timestamp_ntz").alias("hour"), "demand")


def start_hourly_demand(trips: DataFrame, output_path: str, checkpoint_location: str, *,
                        watermark: str = "1 hour", num_zones: int | None = NUM_TAXI_ZONES,
                        trigger_seconds: int | None = 60) -> StreamingQuery:
    """Append closed hours to a parquet table; both paths must be shared storage."""
    writer = (hourly_demand_stream(trips, watermark=watermark, num_zones=num_zones)
              .writeStream.outputMode("append").format("parquet")
              .option("path", output_path).option("checkpointLocation", checkpoint_location))
    if trigger_seconds:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()
