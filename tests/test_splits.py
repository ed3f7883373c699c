import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from zonecast.operators.splits import (cv_folds, cv_folds_by_hour, fold_rows, fold_summary, label_time_split, time_series_cv_split,
                                       time_split, with_positions)


def hours_frame(spark, n_hours, zones=(1,)):
    start = dt.datetime(2026, 1, 1)
    rows = [(z, start + dt.timedelta(hours=i), i) for z in zones for i in range(n_hours)]
    return spark.createDataFrame(rows, "zone_id bigint, hour timestamp_ntz, demand bigint")


def test_split_70_30(spark):
    train, test = time_split(hours_frame(spark, 100), 0.7)
    assert (train.count(), test.count()) == (70, 30)


def test_panel_split_disjoint_and_complete(spark):
    df = hours_frame(spark, 7, zones=(1, 2))
    train, test = time_split(df, 0.8)
    th = {r.hour for r in train.select("hour").distinct().collect()}
    sh = {r.hour for r in test.select("hour").distinct().collect()}
    assert not th & sh and max(th) < min(sh)
    assert train.unionByName(test).exceptAll(df).count() == 0 and train.count() + test.count() == df.count()


def test_single_hour_all_train(spark):
    train, test = time_split(hours_frame(spark, 1, zones=(1, 2)))
    assert (train.count(), test.count()) == (2, 0)
    lab = label_time_split(hours_frame(spark, 1))
    assert {r.split for r in lab.collect()} == {"train"}


@pytest.mark.parametrize("bad", [0.0, 1.0, 1.5, -0.1, "x"])
def test_bad_train_frac(spark, bad):
    with pytest.raises(ValueError):
        time_split(hours_frame(spark, 5), bad)


def test_cv_formula():
    folds = list(time_series_cv_split(24, 3))
    assert [(len(tr), te[0], te[-1] + 1) for tr, te in folds] == [(6, 6, 12), (12, 12, 18), (18, 18, 24)]
    folds = list(time_series_cv_split(10, 3))
    assert [len(tr) for tr, _ in folds] == [4, 6, 8] and all(len(te) == 2 for _, te in folds)
    assert all(tr[-1] < te[0] for tr, te in folds)
    assert [len(te) for _, te in time_series_cv_split(3, 2)] == [1, 1]
    for n, k in [(2, 5), (5, 1), (0, 2), (3.5, 2)]:
        with pytest.raises(ValueError):
            list(time_series_cv_split(n, k))


def test_positions_match_global_row_number(spark):
    df = hours_frame(spark, 50, zones=(3, 1, 2)).repartition(5)
    pos = with_positions(df, ["zone_id", "hour"])
    ref = df.select("zone_id", "hour", (F.row_number().over(Window.orderBy("zone_id", "hour")) - 1).alias("pos"))
    assert pos.select("zone_id", "hour", "pos").exceptAll(ref).count() == 0
    assert pos.count() == 150


def test_cv_folds_on_frame_match_positions(spark):
    folds = cv_folds(hours_frame(spark, 8, zones=(3, 1, 2)).repartition(4), 3)
    assert folds.count() == 24                                  # no row is copied
    rows = {(r.hour, r.zone_id): r.pos for r in folds.collect()}
    assert [rows[k] for k in sorted(rows)] == list(range(24))
    for i, (train, test) in enumerate(time_series_cv_split(24, 3)):
        tr, te = fold_rows(folds, i)
        assert sorted(r.pos for r in tr.collect()) == list(train)
        assert sorted(r.pos for r in te.collect()) == list(test)


def test_cv_folds_never_train_on_the_future(spark):
    folds = cv_folds(hours_frame(spark, 6, zones=(1, 2, 3)), 2)
    for i in range(2):
        tr, te = fold_rows(folds, i)
        assert tr.agg(F.max("hour")).first()[0] <= te.agg(F.min("hour")).first()[0]


def test_fold_summary_equals_the_folds(spark):
    folds = cv_folds(hours_frame(spark, 9, zones=(1, 2)), 4)
    got = {(r.fold, r.role): (r.n, r.lo, r.hi) for r in fold_summary(
        folds, 4, ("n", F.count("*"), F.sum), ("lo", F.min("pos"), F.min), ("hi", F.max("pos"), F.max)).collect()}
    assert len(got) == 8
    for i, (train, test) in enumerate(time_series_cv_split(18, 4)):
        assert got[(i, "train")] == (len(train), train[0], train[-1])
        assert got[(i, "test")] == (len(test), test[0], test[-1])


def test_cv_by_hour_never_mixes_roles(spark):
    folds = cv_folds_by_hour(hours_frame(spark, 30, zones=(1, 2)), 4)
    assert folds.count() == 60
    for i in range(4):
        tr, te = fold_rows(folds, i)
        assert tr.agg(F.max("hour")).first()[0] < te.agg(F.min("hour")).first()[0]


def test_cv_too_few_rows_fails(spark):
    with pytest.raises(Exception, match="more than 5 samples"):
        cv_folds(hours_frame(spark, 3), 5).collect()


def test_cv_positions_are_lazy():
    train, test = next(iter(time_series_cv_split(10**15, 5)))
    assert isinstance(train, range) and isinstance(test, range) and test[0] == len(train)


def test_split_cut_is_zone_free(spark):
    """The fetched cut must not shift with the Python process's local time zone."""
    import os
    import time as _time
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    _time.tzset()
    try:
        train, test = time_split(hours_frame(spark, 100), 0.7)
        assert (train.count(), test.count()) == (70, 30)
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        _time.tzset()
