import datetime as dt

import pytest

from zonecast.operators.windows import add_lags, add_rolling_features
from zonecast.plans.features import build_features


def panel(spark, values_by_zone):
    start = dt.datetime(2026, 1, 1)
    rows = [(z, start + dt.timedelta(hours=i), v) for z, vals in values_by_zone.items()
            for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "zone_id bigint, hour timestamp_ntz, demand bigint")


def col(df, name, zone=None):
    rows = df.orderBy("zone_id", "hour").collect()
    return [r[name] for r in rows if zone is None or r.zone_id == zone]


def test_lag_three(spark):
    out = add_lags(panel(spark, {1: list(range(10))}), (3,))
    assert col(out, "lag_3h")[5] == 2.0
    assert dict(out.dtypes)["lag_3h"] == "double"


def test_lag_24_warm_up(spark):
    out = add_lags(panel(spark, {161: list(range(48))}), (1, 24))
    lags = col(out, "lag_24h")
    assert all(v is None for v in lags[:24]) and lags[24] == 0.0


def test_no_cross_zone_bleed(spark):
    out = add_lags(panel(spark, {1: [1, 2, 3, 4, 5], 2: [10, 20, 30, 40, 50]}), (1,))
    assert col(out, "lag_1h", 2)[0] is None


def test_rolling_mean_excludes_current_row(spark):
    out = add_rolling_features(panel(spark, {1: [10, 20, 30]}), (2,))
    assert col(out, "roll_mean_2h") == [None, 10.0, 15.0]


def test_rolling_std_population_and_zero_fill(spark):
    out = add_rolling_features(panel(spark, {1: [5, 5, 5, 5]}), (2,))
    assert col(out, "roll_std_2h") == [0.0, 0.0, 0.0, 0.0]
    out = add_rolling_features(panel(spark, {1: [1, 3, 5]}), (2,))
    assert col(out, "roll_std_2h") == pytest.approx([0.0, 0.0, 1.0])


def test_rolling_two_zones(spark):
    out = add_rolling_features(panel(spark, {1: [10, 20], 2: [100, 200]}), (2,))
    assert col(out, "roll_mean_2h", 2) == [None, 100.0]


def test_rolling_is_causal(spark):
    base = [1, 2, 3, 4, 5, 6]
    changed = [1, 2, 999, 4, 5, 6]
    a = col(add_rolling_features(panel(spark, {1: base}), (3,)), "roll_mean_3h")
    b = col(add_rolling_features(panel(spark, {1: changed}), (3,)), "roll_mean_3h")
    assert a[:3] == b[:3] and a[3] != b[3]


@pytest.mark.parametrize("bad", [(0,), (-1,), (2.5,), (), (True,)])
def test_bad_lags_and_windows(spark, bad):
    df = panel(spark, {1: [1, 2]})
    with pytest.raises(ValueError):
        add_lags(df, bad)
    with pytest.raises(ValueError):
        add_rolling_features(df, bad)


def test_build_features_default_schema(spark, trips_schema):
    from conftest import ts
    df = spark.createDataFrame([(ts("2026-01-01 08:05"), 3, 1)], trips_schema)
    assert build_features(df).columns == ["zone_id", "hour", "demand", "lag_1h", "lag_24h"]
    with pytest.raises(ValueError):
        build_features(df, rolling_windows=[])
    full = build_features(df, lags=[1], rolling_windows=[2], add_calendar=True)
    assert full.columns[-4:] == ["hour_of_day", "day_of_week", "is_weekend", "is_holiday"]


def test_lags_and_rolling_share_one_window_exchange(spark, trips_schema):
    from conftest import ts
    df = spark.createDataFrame([(ts("2026-01-01 08:05"), 3, 1)], trips_schema)
    plan = build_features(df, lags=[1, 24], rolling_windows=[3, 24])._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("hashpartitioning(zone_id#") <= 2


def test_running_sum_form_equals_frame_form(spark):
    """Integral targets use prefix sums; they must equal the sliding-frame aggregates."""
    import random
    from pyspark.sql import functions as F
    from zonecast.operators.windows import add_window_features, rolling_columns
    rnd = random.Random(3)
    values = {z: [rnd.choice([0, 0, 1, 2, 5, 40, 900]) for _ in range(rnd.randint(1, 60))] for z in range(1, 7)}
    df = panel(spark, values)
    windows = (1, 2, 5, 24)
    fast = add_window_features(df, (1,), windows)
    slow = df.select("*", *rolling_columns(windows))
    joined = fast.alias("a").join(slow.alias("b"), ["zone_id", "hour"])
    for n in windows:
        for stat in ("mean", "std"):
            c = f"roll_{stat}_{n}h"
            diff = joined.where(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
                                & ((F.col(f"a.{c}") - F.col(f"b.{c}")).isNull()
                                   | (F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) > 1e-9)))
            assert diff.count() == 0, c
    assert fast.count() == df.count()


def test_running_sum_form_skips_nulls_and_holds_large_values(spark):
    from pyspark.sql import functions as F
    from zonecast.operators.windows import add_window_features, rolling_columns
    import datetime as dt
    values = {1: [0, None, 2, 3, 4, None, None, None, 7], 2: [3_000_000 + i % 2 for i in range(200)],
              3: [5_000_000_000 + i % 3 for i in range(60)], 4: [None, None], 5: [10**15, 10**15 + 2, 10**15]}
    rows = [(z, dt.datetime(2026, 1, 1) + dt.timedelta(hours=i), v) for z, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "zone_id bigint, hour timestamp_ntz, demand bigint")
    got = {(r.zone_id, r.hour): r for r in add_window_features(df, (), (3, 168)).collect()}
    slow = {(r.zone_id, r.hour): r for r in df.select("*", *rolling_columns((3, 168))).collect()}
    for k, a in got.items():
        b = slow[k]
        for n in (3, 168):
            m, e = a[f"roll_mean_{n}h"], b[f"roll_mean_{n}h"]
            assert (m is None) == (e is None) and (m is None or abs(m - e) < 1e-6 * max(1, abs(e)))
    hour = dt.datetime(2026, 1, 1)
    assert got[(1, hour + dt.timedelta(hours=4))]["roll_mean_3h"] == 2.5
    assert got[(2, hour + dt.timedelta(hours=199))]["roll_std_168h"] == 0.5
    assert abs(got[(3, hour + dt.timedelta(hours=59))]["roll_std_3h"] - (2 / 3) ** 0.5) < 1e-12
    assert got[(5, hour + dt.timedelta(hours=2))]["roll_std_3h"] == 1.0
    assert got[(4, hour + dt.timedelta(hours=1))]["roll_std_3h"] == 0.0


def test_running_sums_of_any_sign_and_size_are_exact(spark):
    """Against whole-number arithmetic: negatives, limbs that cancel, values at the edges of the limbs."""
    import datetime as dt
    import random
    from fractions import Fraction
    from zonecast.operators.windows import add_window_features
    rnd = random.Random(8)
    edges = [0, 1, -1, 2**21 - 1, 2**21, -2**21, 2**42, -2**42, 2**42 - 1, 10**15, -10**15, None]
    zones = {z: [rnd.choice(edges) for _ in range(40)] for z in range(6)}
    zones[7] = [2**42, -2**42, 2**42, -2**42]
    rows = [(z, dt.datetime(2026, 1, 1) + dt.timedelta(hours=i), v) for z, vs in zones.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "zone_id bigint, hour timestamp_ntz, demand bigint")
    start = dt.datetime(2026, 1, 1)
    for r in add_window_features(df, (), (2, 9)).collect():
        i = int((r.hour - start).total_seconds() // 3600)
        for n in (2, 9):
            seen = [v for v in zones[r.zone_id][max(0, i - n):i] if v is not None]
            if not seen:
                assert r[f"roll_mean_{n}h"] is None and r[f"roll_std_{n}h"] == 0.0
                continue
            mean = Fraction(sum(seen), len(seen))
            std = float(sum((v - mean) ** 2 for v in seen) / len(seen)) ** 0.5
            assert abs(r[f"roll_mean_{n}h"] - float(mean)) <= 1e-15 * abs(float(mean)) + 1e-12
            assert abs(r[f"roll_std_{n}h"] - std) <= 1e-14 * std


def test_lags_default(spark):
    from zonecast.operators.windows import add_lags
    import datetime as dt
    df = spark.createDataFrame([(1, dt.datetime(2026, 1, 1), 1)], "zone_id bigint, hour timestamp_ntz, demand bigint")
    assert add_lags(df, None).columns[-2:] == ["lag_1h", "lag_24h"]
