import math

import pytest
from pyspark.sql import functions as F

from conftest import ts
from zonecast.operators.cleaning import clean_report, clean_trips
from zonecast.sources.trips import month_path, read_raw


def test_range_ends_kept(spark, trips_schema):
    rows = [(ts("2026-01-01 08:00"), i, 5) for i in (1, 265, 266, 0)]
    out = clean_trips(spark.createDataFrame(rows, trips_schema))
    assert sorted(r.PULocationID for r in out.collect()) == [1, 265]


def test_null_time_and_ids_dropped(spark):
    rows = [(ts("2026-01-01 08:00"), 1.0, 2.0), (None, 1.0, 2.0), (ts("2026-01-01 09:00"), None, 2.0),
            (ts("2026-01-01 09:00"), float("nan"), 2.0), (ts("2026-01-01 10:00"), 3.7, 4.2)]
    df = spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, PULocationID double, DOLocationID double")
    out = clean_trips(df).orderBy("pickup_datetime").collect()
    assert [(r.PULocationID, r.DOLocationID) for r in out] == [(1, 2), (3, 4)]
    assert dict(clean_trips(df).dtypes)["PULocationID"] == "bigint"


def test_text_times_are_coerced_and_bad_ones_dropped(spark):
    df = spark.createDataFrame([("2026-01-01 08:05:00", 1, 1), ("not-a-date", 1, 1)],
                               "pickup_datetime string, PULocationID bigint, DOLocationID bigint")
    out = clean_trips(df)
    assert dict(out.dtypes)["pickup_datetime"] == "timestamp_ntz"
    assert out.count() == 1


def test_extra_columns_flow_and_input_untouched(spark, trips_schema):
    df = spark.createDataFrame([(ts("2026-01-01 08:00"), 1, 2)], trips_schema).withColumn("fare", F.lit(9.5))
    out = clean_trips(df)
    assert out.columns == ["pickup_datetime", "PULocationID", "DOLocationID", "fare"]
    assert df.columns == out.columns


@pytest.mark.parametrize("bad", [0, -1, 2.5, True])
def test_bad_num_zones(spark, trips_schema, bad):
    df = spark.createDataFrame([], trips_schema)
    with pytest.raises(ValueError):
        clean_trips(df, num_zones=bad)


def test_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "wrong_col int")
    with pytest.raises(ValueError, match="missing required columns"):
        clean_trips(df)


def test_clean_report_counts(spark, trips_schema):
    rows = [(ts("2026-01-01 08:00"), 1, 1), (None, 1, 1), (ts("2026-01-01 08:00"), 0, 1),
            (ts("2026-01-01 08:00"), 1, 300)]
    r = clean_report(spark.createDataFrame(rows, trips_schema)).first()
    assert (r.rows_in, r.rows_null, r.pu_out_of_range, r.do_out_of_range, r.rows_out) == (4, 1, 1, 1, 1)


def test_scan_prunes_columns_and_pushes_filters(spark, tmp_path):
    path = str(tmp_path / "trips.parquet")
    spark.createDataFrame([(ts("2026-01-01 08:00"), 1, 2, 3.5)],
                          "pickup_datetime timestamp_ntz, PULocationID bigint, DOLocationID bigint, fare double") \
         .write.parquet(path)
    plan = clean_trips(read_raw(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "fare" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert "GreaterThanOrEqual(PULocationID,1)" in plan


def test_read_raw_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw(spark, str(tmp_path / "nope.parquet"))
    path = str(tmp_path / "bad.parquet")
    spark.createDataFrame([(1,)], "wrong_col int").write.parquet(path)
    with pytest.raises(ValueError, match="missing required columns"):
        read_raw(spark, path)


def test_month_path_rules():
    assert month_path("/data", 2026, 1).endswith("fhvhv_tripdata_2026-01.parquet")
    for y, m in [(2018, 5), (2019, 1), (2026, 13), (2100, 1)]:
        with pytest.raises(ValueError):
            month_path("/data", y, m)
    assert not math.isnan(1.0)
