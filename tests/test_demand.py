import datetime as dt

from pyspark.sql import functions as F

from conftest import ts
from zonecast.operators.demand import aggregate


def _gap_trips(spark, days=5, per_hour=10, gap=(2, 12)):
    start = dt.datetime(2026, 1, 1)
    rows = []
    for d in range(days):
        for h in range(24):
            if (d, h) == gap:
                continue
            for i in range(per_hour):
                rows.append((start + dt.timedelta(days=d, hours=h, minutes=5 * i), 1, 2))
    return spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, PULocationID bigint, DOLocationID bigint")


def test_same_hour_counts_together(spark, trips_schema):
    df = spark.createDataFrame([(ts("2026-01-01 08:05"), 161, 1), (ts("2026-01-01 08:45"), 161, 1)], trips_schema)
    out = aggregate(df).collect()
    assert len(out) == 1 and out[0].demand == 2 and out[0].hour == ts("2026-01-01 08:00")
    assert aggregate(df).columns == ["zone_id", "hour", "demand"]


def test_demand_sums_to_rows(spark):
    df = _gap_trips(spark)
    assert aggregate(df).agg(F.sum("demand")).first()[0] == df.count()


def test_fill_missing_hours(spark):
    df = _gap_trips(spark)
    assert aggregate(df).count() == 119
    filled = aggregate(df, fill_missing_hours=True)
    assert filled.count() == 120
    by_hour = {r.hour: r.demand for r in filled.collect()}
    assert by_hour[ts("2026-01-03 12:00")] == 0
    from zonecast.operators.windows import add_lags
    lagged = {r.hour: r.lag_24h for r in add_lags(filled, (24,)).collect()}
    assert lagged[ts("2026-01-03 13:00")] == by_hour[ts("2026-01-02 13:00")]


def test_grid_uses_global_bounds(spark, trips_schema):
    rows = [(ts("2026-01-01 00:10"), 1, 1), (ts("2026-01-01 03:10"), 2, 1)]
    filled = aggregate(spark.createDataFrame(rows, trips_schema), fill_missing_hours=True)
    counts = {r.zone_id: r.n for r in filled.groupBy("zone_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {1: 4, 2: 4}


def test_empty_input_stays_empty(spark, trips_schema):
    empty = spark.createDataFrame([], trips_schema)
    assert aggregate(empty, fill_missing_hours=True).count() == 0


def test_null_keys_not_counted(spark, trips_schema):
    rows = [(ts("2026-01-01 00:10"), None, 1), (None, 1, 1), (ts("2026-01-01 00:20"), 1, 1)]
    out = aggregate(spark.createDataFrame(rows, trips_schema)).collect()
    assert [(r.zone_id, r.demand) for r in out] == [(1, 1)]


def test_day_grain(spark, trips_schema):
    rows = [(ts("2026-01-01 00:10"), 1, 1), (ts("2026-01-01 23:10"), 1, 1), (ts("2026-01-03 05:00"), 1, 1)]
    out = aggregate(spark.createDataFrame(rows, trips_schema), grain="day", out_time="day",
                    fill_missing_hours=True).orderBy("day").collect()
    assert [r.demand for r in out] == [2, 0, 1]


def test_no_grid_sized_shuffle_before_window(spark):
    """Grid join and per-zone window reuse the zone partitioning of the key aggregate."""
    import re
    from zonecast.operators.windows import add_lags
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = add_lags(aggregate(_gap_trips(spark), fill_missing_hours=True), (1,))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert keys, plan
    # only zone-keyed exchanges after the checkpointed panel: no (zone, hour) grid shuffle
    assert all("hour" not in k for k in keys), keys
