import datetime as dt

import numpy as np
import pytest

from zonecast.ml.evaluate import evaluate_model, model_comparison, naive_baseline
from zonecast.ml.forecaster import DemandForecaster, MultiModelForecaster
from zonecast.ml.models import linear_coefficients, make_pipeline, train_models


@pytest.fixture(scope="module")
def feats(spark):
    rng = np.random.default_rng(7)
    n = 200
    l1 = rng.integers(0, 50, n).astype(float)
    l24 = rng.integers(0, 50, n).astype(float)
    y = 0.6 * l1 + 0.4 * l24 + rng.normal(0, 1, n) + 3.0
    start = dt.datetime(2026, 1, 1)
    rows = [(1, start + dt.timedelta(hours=i), float(y[i]), float(l1[i]), float(l24[i])) for i in range(n)]
    return spark.createDataFrame(rows, "zone_id bigint, hour timestamp_ntz, demand double, "
                                       "lag_1h double, lag_24h double")


def _np(df):
    pdf = df.toPandas()
    return pdf[["lag_1h", "lag_24h"]].to_numpy(), pdf["demand"].to_numpy()


def test_ols_equals_normal_equations(feats):
    X, y = _np(feats)
    A = np.column_stack([np.ones(len(y)), X])
    beta = np.linalg.lstsq(A, y, rcond=None)[0]
    c = DemandForecaster().fit(feats).coefficients()
    assert [c["intercept"], c["coef_lag_1h"], c["coef_lag_24h"]] == pytest.approx(beta, abs=1e-9)


@pytest.mark.parametrize("scaler", [True, False])
def test_ridge_matches_closed_form(feats, scaler):
    X, y = _np(feats)
    n, alpha = len(y), 1.0
    mu, sd = X.mean(0), X.std(0)
    Z = (X - mu) / sd if scaler else X - mu
    b = np.linalg.solve(Z.T @ Z + alpha * np.eye(2), Z.T @ (y - y.mean()))
    coef = b / sd if scaler else b
    c = linear_coefficients(make_pipeline("ridge", scaler=scaler).fit(feats), ("lag_1h", "lag_24h"))
    assert [c["coef_lag_1h"], c["coef_lag_24h"]] == pytest.approx(coef, abs=1e-8)
    assert c["intercept"] == pytest.approx(y.mean() - coef @ mu, abs=1e-8)
    del n


def test_forest_reproducible(feats):
    a = make_pipeline("random_forest").fit(feats).transform(feats).select("prediction").collect()
    b = make_pipeline("random_forest").fit(feats).transform(feats).select("prediction").collect()
    assert a == b


def test_forest_of_repeated_rows_is_fitted_to_the_distinct_ones(spark, monkeypatch):
    """Few distinct rows: fitted from their bootstrap counts, the same however the rows lie; others as before."""
    from pyspark.ml.regression import RandomForestRegressor
    from pyspark.sql import functions as F

    from zonecast.ml import models
    monkeypatch.setattr(models, "DISTINCT_FROM", 1000)
    monkeypatch.setattr(models, "FOREST_TREES", 6)
    a, b = F.col("id") % 3, F.col("id") % 4
    rows = spark.range(6000).select(a.alias("lag_1h"), b.alias("lag_24h"), (10 * a + b + F.col("id") % 5).alias("demand"))
    with models._prepared(rows, models.DEFAULT_FEATURE_COLUMNS, "demand") as (_, n, _std):
        assert n == 6000
    fit_rows, plain = [], RandomForestRegressor._fit
    monkeypatch.setattr(RandomForestRegressor, "_fit", lambda self, df: fit_rows.append(df.count()) or plain(self, df))

    def scores(df):
        model = make_pipeline("random_forest").fit(df)
        assert model.stages[-1].getNumTrees == 6
        cells = rows.groupBy("lag_1h", "lag_24h").agg(F.avg("demand").alias("mean")).orderBy("lag_1h", "lag_24h")
        return [(r.mean, r.prediction) for r in model.transform(cells).collect()]
    got = scores(rows)
    assert fit_rows == [] and got == scores(rows.repartition(5))
    assert len(got) == 12 and all(abs(m - p) < 0.3 for m, p in got)         # 500 rows a cell, six samples
    scores(rows.withColumn("demand", F.col("demand") + F.monotonically_increasing_id() / 1e6))
    assert fit_rows == [6000]                                              # all rows differ
    counts = models.bootstrap_counts(spark.createDataFrame([(1.0, 400), (2.0, 1)], "x double, _n long"), ["x"], 300, 7).orderBy("x").collect()
    mean, var = zip(*[(np.mean(r._counts), np.var(r._counts)) for r in counts], strict=True)
    assert mean == pytest.approx((400, 1), rel=0.15) and var == pytest.approx((400, 1), rel=0.4)


def test_empty_training_set(spark, feats):
    from pyspark.sql import functions as F
    empty = feats.withColumn("lag_1h", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="empty"):
        DemandForecaster().fit(empty)


def test_unfitted_and_missing_columns(feats):
    with pytest.raises(RuntimeError):
        DemandForecaster().transform(feats)
    with pytest.raises(ValueError):
        DemandForecaster(feature_columns=("nope",)).fit(feats)
    with pytest.raises(ValueError):
        make_pipeline("svm")
    with pytest.raises(ValueError):
        train_models(feats, [])


def test_predictions_row_aligned(feats):
    m = DemandForecaster().fit(feats)
    out = m.transform(feats)
    assert out.count() == feats.count() and "prediction" in out.columns


def test_evaluate_keys_and_alignment(spark, feats):
    from pyspark.sql import functions as F
    m = DemandForecaster(feature_columns=("lag_1h", "lag_24h", "lag_168h"))
    with_168 = feats.withColumn("lag_168h", F.when(F.col("lag_1h") > 10, F.col("lag_1h")))
    m.fit(with_168)
    r = evaluate_model(m, with_168).first().asDict()
    assert sorted(r) == ["baseline_mae", "baseline_rmse", "model_mae", "model_rmse"]
    r6 = evaluate_model(m, with_168, include_mape=True).first().asDict()
    assert len(r6) == 6 and all(isinstance(v, float) for v in r6.values())
    rows = naive_baseline(with_168, extra_dropna_columns=["lag_168h"])
    kept = with_168.dropna(subset=["lag_1h", "lag_24h", "lag_168h", "demand"])
    base_mae = rows.agg(F.avg(F.abs(F.col("demand") - F.col("baseline")))).first()[0]
    assert rows.count() == kept.count() and base_mae == pytest.approx(r["baseline_mae"])


def test_save_load_contract(spark, feats, tmp_path):
    m = DemandForecaster(feature_columns=("lag_24h", "lag_1h")).fit(feats)
    m.save(str(tmp_path / "m"))
    other = DemandForecaster().load(str(tmp_path / "m"))
    assert other.feature_columns == ["lag_24h", "lag_1h"]
    a = m.transform(feats).select("prediction").collect()
    assert other.transform(feats).select("prediction").collect() == a


def test_multi_model(feats):
    multi = MultiModelForecaster(model_names=[]).fit(feats)
    assert sorted(multi.models) == ["linear", "random_forest", "ridge"]
    table = {r.model: r for r in model_comparison(multi, feats).collect()}
    assert set(table) == {"linear", "ridge", "random_forest", "baseline-lag24"}
    assert table["linear"].rmse >= table["linear"].mae
    with pytest.raises(ValueError):
        MultiModelForecaster(model_names=["linear"]).fit(feats).transform(feats, "ridge")


def test_legacy_artifact_keeps_constructor_columns(feats, tmp_path):
    m = DemandForecaster().fit(feats)
    m.model.write().overwrite().save(str(tmp_path / "old" / "pipeline"))   # no contract beside it
    other = DemandForecaster(feature_columns=("lag_1h", "lag_24h"), target_column="demand")
    other.load(str(tmp_path / "old"))
    assert other.feature_columns == ["lag_1h", "lag_24h"] and other.target_column == "demand"


def test_duck_typed_model_and_numeric_guard(spark, feats):
    from pyspark.sql import functions as F

    class Persistence:                      # any object with feature_columns + predict
        feature_columns = ["lag_1h"]

        def predict(self, df):
            return df.withColumn("prediction", F.col("lag_1h"))

    r = evaluate_model(Persistence(), feats).first()
    want = feats.agg(F.avg(F.abs(F.col("demand") - F.col("lag_1h")))).first()[0]
    assert r.model_mae == pytest.approx(want)
    with pytest.raises(ValueError, match="numeric"):
        DemandForecaster(feature_columns=("lag_1h", "label")).fit(feats.withColumn("label", F.lit("x")))


def test_forest_does_not_depend_on_the_input_layout(spark):
    from pyspark.sql import functions as F
    rows = spark.range(4000).select(
        F.col("id").alias("zone_id"), (F.col("id") % 17).cast("double").alias("lag_1h"),
        (F.col("id") % 5).cast("double").alias("lag_24h"), ((F.col("id") * 7919) % 23).alias("demand"))
    sums = []
    for n in (1, 3, 8):
        model = make_pipeline("random_forest").fit(rows.repartition(n))
        sums.append(model.transform(rows.where("zone_id < 200")).agg(F.sum("prediction")).first()[0])
    assert max(sums) - min(sums) < 1e-9


def test_unfitted_multi_model_and_default_pipeline(spark):
    from zonecast.ml.forecaster import MultiModelForecaster
    df = spark.createDataFrame([(1.0, 2.0, 3)], "lag_1h double, lag_24h double, demand bigint")
    with pytest.raises(RuntimeError):
        MultiModelForecaster().transform(df)
    assert make_pipeline().name == "linear"
