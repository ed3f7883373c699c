"""Report tables: zone totals, heatmap, daily counts, anomalies, profiles.

Each report is one aggregate pass over its input plus, at most, a tiny
one-row total or a top-K; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.columns import is_numeric_type, is_time_type, require_columns

HOURS_OF_DAY = range(24)


def zone_totals(panel: DataFrame, *, key: str = "zone_id", value: str = "demand") -> DataFrame:
    require_columns(panel, (key, value), "demand panel")
    return panel.groupBy(key).agg(F.sum(value).cast("bigint").alias("total_demand"))


def top_zones(panel: DataFrame, k: int = 20, *, key: str = "zone_id", value: str = "demand") -> DataFrame:
    """The ``k`` zones with the largest total (ties broken by zone id)."""
    return zone_totals(panel, key=key, value=value).orderBy(F.desc("total_demand"), key).limit(k)


def demand_heatmap(panel: DataFrame, top: int = 20, *, key: str = "zone_id",
                   time: str = "hour", value: str = "demand") -> DataFrame:
    """Mean demand per zone × hour of day for the ``top`` busiest zones.

    Columns ``h00..h23`` always exist (null where a zone has no row at that
    hour of day).  Totals and the 24 means come from one aggregate keyed by
    zone, so there is no join back to a top-zone list.
    """
    require_columns(panel, (key, time, value), "demand panel")
    if not is_time_type(panel.schema[time].dataType):
        raise ValueError(f"column {time!r} must be a timestamp")
    hod = F.hour(time)
    means = [F.avg(F.when(hod == h, F.col(value).cast("double"))).alias(f"h{h:02d}")
             for h in HOURS_OF_DAY]
    wide = panel.groupBy(key).agg(F.sum(value).cast("bigint").alias("total_demand"), *means)
    return wide.orderBy(F.desc("total_demand"), key).limit(top)


def forecast_vs_actual(features: DataFrame, model, zone_id: int, *, key: str = "zone_id",
                       time: str = "hour") -> DataFrame:
    """``(hour, demand, prediction)`` for one zone, ordered by hour."""
    target = getattr(model, "target_column", "demand")
    one = features.where(F.col(key) == F.lit(zone_id))
    return model.transform(one).select(time, target, "prediction").orderBy(time)


def daily_counts(trips: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """``(date, pickups)`` per calendar date."""
    require_columns(trips, (ts,), "trip table")
    return (trips.where(F.col(ts).isNotNull())
                 .groupBy(F.to_date(ts).alias("date"))
                 .agg(F.count(F.lit(1)).alias("pickups")))


def daily_summary(daily: DataFrame) -> DataFrame:
    """One row: days, total, mean, exact median, quietest and busiest day.

    Ties on the count pick the earliest date.
    """
    return daily.agg(
        F.count(F.lit(1)).alias("n_days"),
        F.sum("pickups").cast("bigint").alias("total_pickups"),
        F.avg(F.col("pickups").cast("double")).alias("mean_pickups"),
        F.median(F.col("pickups").cast("double")).alias("median_pickups"),
        F.min(F.struct("pickups", "date"))["date"].alias("quietest_day"),
        F.min("pickups").alias("quietest_pickups"),
        F.min(F.struct(-F.col("pickups"), F.col("date")))["date"].alias("busiest_day"),
        F.max("pickups").alias("busiest_pickups"),
    )


def weekday_zscore(daily: DataFrame, *, date: str = "date", value: str = "pickups") -> DataFrame:
    """Leave-one-out z-score of each day against the other days of its weekday.

    ``z = (x - mean(peers)) / std(peers, ddof=1)``; 0 when there are fewer
    than two peers or their spread is zero.  Closed form over weekday sums, so
    no self-join: with ``S``, ``Q``, ``n`` the weekday's sum, sum of squares
    and count, the peers have mean ``(S-x)/(n-1)`` and sample variance
    ``((n-1)(Q-x²) - (S-x)²) / ((n-1)(n-2))``, numerator in exact decimal.
    """
    require_columns(daily, (date, value), "daily counts")
    dec = T.DecimalType(38, 0)
    x = F.col(value).cast(dec)
    w = Window.partitionBy("weekday")
    base = daily.select(date, value, F.weekday(date).alias("weekday"))
    stats = base.select("*", F.sum(x).over(w).alias("_S"), F.sum(x * x).over(w).alias("_Q"),
                        F.count(F.lit(1)).over(w).alias("_n"))
    n1 = (F.col("_n") - 1).cast(dec)
    peer_sum = F.col("_S") - x
    var_num = n1 * (F.col("_Q") - x * x) - peer_sum * peer_sum
    var = var_num.cast("double") / (n1 * (F.col("_n") - 2).cast(dec)).cast("double")
    mu = peer_sum.cast("double") / n1.cast("double")
    z = F.when((F.col("_n") >= 3) & (var_num > 0),
               (F.col(value).cast("double") - mu) / F.sqrt(var)).otherwise(F.lit(0.0))
    peer_mean = F.when(F.col("_n") >= 2, mu)
    return stats.select(date, value, F.date_format(date, "E").alias("weekday_name"),
                        peer_mean.alias("peer_mean"), z.alias("zscore"))


def weekday_anomalies(daily: DataFrame, holidays=None, *, date: str = "date",
                      value: str = "pickups") -> DataFrame:
    """Daily counts with their weekday z-score and a holiday flag.

    Built-in calendars are rules over the date; other dates are joined
    without a hint.
    """
    from zonecast.functions.holidays import holiday_dates, is_holiday
    z = weekday_zscore(daily, date=date, value=value)
    if holidays is None or isinstance(holidays, str):
        return z.withColumn("is_holiday", is_holiday(F.col(date), holidays or "federal").cast("int"))
    hol = holiday_dates(daily.sparkSession, holidays).withColumnRenamed("holiday_date", "_h")
    return (z.join(hol, F.col(date) == F.col("_h"), "left")
             .select(*z.columns, F.col("_h").isNotNull().cast("int").alias("is_holiday")))


def top_zones_share(trips: DataFrame, k: int = 10, *, id_column: str = "PULocationID") -> DataFrame:
    """Busiest pickup zones with their share of all trips.

    The total is a scalar subquery over the per-zone counts (one value; the
    counts' shuffle is reused), not a global window.
    """
    require_columns(trips, (id_column,), "trip table")
    counts = (trips.where(F.col(id_column).isNotNull())
                   .groupBy(F.col(id_column).cast("bigint").alias("zone_id"))
                   .agg(F.count(F.lit(1)).alias("pickups")))
    total = counts.agg(F.sum("pickups")).scalar()
    return (counts.select("zone_id", "pickups", (F.col("pickups") / total).alias("share"))
                  .orderBy(F.desc("pickups"), "zone_id").limit(k))


def column_profile(df: DataFrame, columns, *, lo: int = 1, hi: int | None = None) -> DataFrame:
    """Per column: type, nulls, min, max, exact distinct count, out of ``[lo, hi]``.

    One pass for any number of columns: rows are unpivoted to (column, value),
    with a slot for each of the types that occur, and counted by value, which
    combines map-side; all figures are then aggregates of those counts.
    """
    cols = list(dict.fromkeys(columns))
    require_columns(df, cols, "DataFrame")
    types = [df.schema[c].dataType.simpleString() for c in cols]
    slots = {t: f"v{i}" for i, t in enumerate(dict.fromkeys(types))}
    cells = F.array(*[F.struct(F.lit(i).alias("c"), *[(F.col(f"`{c}`") if t == types[i] else F.lit(None).cast(t)).alias(v) for t, v in slots.items()])
                      for i, c in enumerate(cols)])
    counts = df.select(F.inline(cells)).groupBy("c", *slots.values()).agg(F.count(F.lit(1)).alias("n"))

    def of_type(make):
        """``make(slot)`` for the slot that the row's column uses."""
        return F.coalesce(*[F.when(F.col("c").isin([i for i, u in enumerate(types) if u == t]), make(F.col(v))) for t, v in slots.items()])
    value_is_null = of_type(lambda v: v.isNull())
    aggregates = [F.sum(F.when(value_is_null, F.col("n"))).alias("null_count"), F.count_if(~value_is_null).alias("n_distinct")]
    for v in slots.values():
        aggregates += [F.min(v).cast("string").alias(f"min_{v}"), F.max(v).cast("string").alias(f"max_{v}")]
    outside = F.lit(None).cast("bigint")
    if hi is not None:
        # null for a column that cannot be compared with numbers
        numeric = [v for t, v in slots.items() if is_numeric_type(df.schema[cols[types.index(t)]].dataType)]
        aggregates += [F.coalesce(F.sum(F.when(~F.col(v).between(lo, hi), F.col("n"))), F.lit(0)).alias(f"out_{v}") for v in numeric]
    found = counts.groupBy("c").agg(*aggregates)
    meta = F.array(*[F.struct(F.lit(i).alias("c"), F.lit(c).alias("column"), F.lit(t).alias("type")) for i, (c, t) in enumerate(zip(cols, types))])
    named = df.sparkSession.range(1).select(F.inline(meta)).join(found, "c", "left")       # a table without rows has a profile too
    if hi is not None:
        outside = F.coalesce(*[F.when(F.col("type") == t, F.coalesce(f"out_{v}", F.lit(0))) for t, v in slots.items() if v in numeric], outside)

    def pick(kind):
        return F.coalesce(*[F.when(F.col("type") == t, F.col(f"{kind}_{v}")) for t, v in slots.items()])
    return named.select("column", "type", F.coalesce("null_count", F.lit(0)).alias("null_count"), pick("min").alias("min_value"),
                        pick("max").alias("max_value"), F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), outside.alias("out_of_range"))
