import datetime as dt

import pytest

from zonecast.operators.reports import (column_profile, daily_summary, demand_heatmap,
                                        forecast_vs_actual, top_zones, top_zones_share,
                                        weekday_zscore)

# Published daily pickup totals of one month (January 2026),
# used as the golden input for the weekday anomaly report.
DAILY_2026_01 = [
    730355, 600947, 640262, 572075, 552678, 565093, 580665, 617258, 699547, 833940,
    672785, 600183, 605814, 620274, 704259, 784122, 806362, 721685, 606810, 683479,
    678801, 686127, 804588, 880274, 322276, 439462, 682417, 727157, 770967, 864832,
    884879,
]


@pytest.fixture(scope="module")
def daily(spark):
    rows = [(dt.date(2026, 1, i + 1), v) for i, v in enumerate(DAILY_2026_01)]
    return spark.createDataFrame(rows, "date date, pickups bigint")


def test_daily_summary_golden(daily):
    r = daily_summary(daily).first()
    assert r.total_pickups == 20940373 and r.n_days == 31
    assert round(r.mean_pickups) == 675496 and r.median_pickups == 682417
    assert r.quietest_day == dt.date(2026, 1, 25) and r.busiest_day == dt.date(2026, 1, 31)


def test_weekday_zscore_golden(daily):
    z = {r.date.day: r.zscore for r in weekday_zscore(daily).collect()}
    assert z[1] == pytest.approx(0.565, abs=5e-4)
    assert z[19] == pytest.approx(0.921, abs=5e-4)
    assert z[25] == pytest.approx(-4.368, abs=5e-4)
    assert z[26] == pytest.approx(-4.982, abs=5e-4)


def _panel(spark):
    start = dt.datetime(2026, 1, 1)
    rows = [(z, start + dt.timedelta(hours=h), z * 10 + h % 3) for z in (1, 2, 3) for h in range(30)]
    return spark.createDataFrame(rows, "zone_id bigint, hour timestamp_ntz, demand bigint")


def test_heatmap_shape_and_order(spark):
    hm = demand_heatmap(_panel(spark), top=2).collect()
    assert [r.zone_id for r in hm] == [3, 2]
    assert len([c for c in hm[0].asDict() if c.startswith("h")]) == 24
    assert hm[0].h00 == pytest.approx((30 + 30) / 2)
    assert top_zones(_panel(spark), 20).count() == 3


def test_heatmap_needs_timestamp(spark):
    df = spark.createDataFrame([(1, "x", 1)], "zone_id bigint, hour string, demand bigint")
    with pytest.raises(ValueError):
        demand_heatmap(df)


def test_top_zone_share(spark):
    trips = spark.createDataFrame([(1,), (1,), (1,), (2,)], "PULocationID bigint")
    rows = top_zones_share(trips, 10).collect()
    assert [(r.zone_id, r.pickups, r.share) for r in rows] == [(1, 3, 0.75), (2, 1, 0.25)]


def test_column_profile(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (300,), (1,)], "PULocationID bigint")
    r = column_profile(df, ["PULocationID"], lo=1, hi=265).first()
    assert (r.null_count, r.min_value, r.max_value, r.n_distinct, r.out_of_range) == (1, "0", "300", 3, 2)


def test_forecast_vs_actual_one_zone_in_hour_order(spark):
    from zonecast.ml.forecaster import DemandForecaster
    start = dt.datetime(2026, 1, 1)
    rows = [(z, start + dt.timedelta(hours=h), float(h % 5 + z), float((h - 1) % 5 + z), float(h % 3))
            for z in (1, 2) for h in range(40)]
    df = spark.createDataFrame(rows, "zone_id bigint, hour timestamp_ntz, demand double, "
                                     "lag_1h double, lag_24h double").repartition(3)
    m = DemandForecaster().fit(df)
    out = forecast_vs_actual(df, m, 2).collect()
    assert len(out) == 40 and [r.hour for r in out] == sorted(r.hour for r in out)
    assert set(out[0].asDict()) == {"hour", "demand", "prediction"}
