import math

import pytest

from zonecast.functions.metrics import mae, mape, regression_metrics, rmse


def frame(spark, ys, ps):
    return spark.createDataFrame(list(zip(map(float, ys), map(float, ps))), "y double, p double")


def test_mae(spark):
    assert frame(spark, [10, 20, 30], [12, 18, 33]).agg(mae("y", "p")).first()[0] == pytest.approx(7 / 3)


def test_rmse(spark):
    assert frame(spark, [0, 0], [3, 4]).agg(rmse("y", "p")).first()[0] == pytest.approx(math.sqrt(12.5))


def test_mape(spark):
    assert frame(spark, [10, 20, 30], [12, 18, 30]).agg(mape("y", "p")).first()[0] == pytest.approx(0.1)
    v = frame(spark, [0, 10], [1, 10]).agg(mape("y", "p")).first()[0]
    assert math.isfinite(v) and v > 1e6
    with pytest.raises(ValueError):
        mape("y", "p", -1.0)


def test_rmse_at_least_mae(spark):
    r = regression_metrics(frame(spark, [1, 5, 9, 2], [2, 2, 2, 2]), "y", "p").first()
    assert r.rmse >= r.mae and r.n == 4


def test_empty_metrics_fail(spark):
    with pytest.raises(Exception, match="at least one row"):
        regression_metrics(frame(spark, [], []), "y", "p").collect()
