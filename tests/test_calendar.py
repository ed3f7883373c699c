import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import ts
from zonecast.functions.holidays import holiday_table, holiday_table_for, is_holiday
from zonecast.operators.calendar import add_calendar_features


def feats(spark, hours, holidays=None):
    df = spark.createDataFrame([(ts(h),) for h in hours], "hour timestamp_ntz")
    return add_calendar_features(df, holidays).orderBy("hour").collect()


def test_calendar_parts_of_other_years(spark):
    rows = feats(spark, ["1996-02-29 05:00", "2031-06-01 23:00"])
    assert [(r.hour_of_day, r.day_of_week, r.is_weekend) for r in rows] == [(5, 3, 0), (23, 6, 1)]


def test_federal_rules_hold_in_any_year(spark):
    rows = feats(spark, ["1993-12-31 12:00", "1994-07-04 00:00", "2018-12-25 08:00", "2021-12-31 10:00", "2027-07-05 09:00",
                         "2020-06-19 09:00", "2044-01-18 09:00", "2044-01-19 09:00"])
    assert [r.is_holiday for r in rows] == [1, 1, 1, 0, 1, 1, 1, 0]      # in order of time


def test_rules_on_dates_equal_the_tables(spark):
    for cal in ("federal", "state"):
        days = spark.sql("SELECT explode(sequence(DATE'1989-12-25', DATE'2051-01-10')) AS d")
        hit = {r.d for r in days.where(is_holiday(F.col("d"), cal)).collect()}
        table = {r.holiday_date for r in holiday_table(spark, cal, 1989, 2052).collect()}
        assert hit == {d for d in table if dt.date(1989, 12, 25) <= d <= dt.date(2051, 1, 10)}


def test_table_for_a_frame_reaches_the_last_december(spark):
    df = spark.createDataFrame([(ts("2020-03-01 00:00"),), (ts("2021-06-01 00:00"),)], "hour timestamp_ntz")
    got = {r.holiday_date for r in holiday_table_for(df, "hour").collect()}
    assert dt.date(2021, 12, 31) in got and min(got).year == 2020 and max(got).year == 2021


def test_state_calendar(spark):
    assert feats(spark, ["2026-02-12 09:00"])[0].is_holiday == 0
    assert feats(spark, ["2026-02-12 09:00"], "state")[0].is_holiday == 1


def test_custom_calendar(spark):
    rows = feats(spark, ["2026-03-15 10:00", "2026-03-16 10:00"], ["2026-03-15"])
    assert [r.is_holiday for r in rows] == [1, 0]


def test_unparseable_hour_fails(spark):
    df = spark.createDataFrame([("not-a-date",)], "hour string")
    with pytest.raises(Exception, match="unparseable"):
        add_calendar_features(df).collect()
    with pytest.raises(ValueError):
        add_calendar_features(spark.createDataFrame([(1,)], "x int"))


def test_calendar_sizes(spark):
    fed = holiday_table(spark, "federal", 2019, 2026)
    per_year = {r[0]: r[1] for r in fed.groupBy(F.year("holiday_date")).count().collect()}
    assert fed.count() == 86
    assert per_year == {2019: 10, 2020: 10, 2021: 12, 2022: 10, 2023: 11, 2024: 11, 2025: 11, 2026: 11}
    state = holiday_table(spark, "state", 2019, 2026)
    assert state.count() == 110
    assert state.join(fed, "holiday_date", "left_anti").count() == 24
    dates = {str(r[0]) for r in fed.collect()}
    # observed-date rules: Sat -> Fri, Sun -> Mon, across the year boundary
    assert {"2021-12-31", "2021-12-24", "2022-06-20", "2023-11-10", "2026-07-03"} <= dates
    assert "2020-06-19" not in dates                 # Juneteenth only from 2021


def test_rule_calendars_have_unique_dates(spark):
    for cal in ("federal", "state"):
        t = holiday_table(spark, cal, 1990, 2060)
        assert t.count() == t.select("holiday_date").distinct().count()


def test_built_in_calendars_name_their_years(spark):
    from zonecast.functions.holidays import holiday_dates
    with pytest.raises(ValueError, match="first_year"):
        holiday_dates(spark)
    got = [str(r[0]) for r in holiday_dates(spark, "federal", 2030, 2030).collect()]
    assert "2030-07-04" in got and len(got) == 11 and holiday_dates(spark, ["2026-01-01", "2026-01-01"]).count() == 1
