"""End-to-end forecast report: trips → grid → lags → split → models → top-K."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.ml.evaluate import evaluate_model, model_comparison
from zonecast.ml.forecaster import DemandForecaster, MultiModelForecaster
from zonecast.operators.demand import aggregate, materialized
from zonecast.operators.splits import time_split
from zonecast.operators.windows import lag_columns
from zonecast.operators.zones import ZoneResolver

DEFAULT_TOP_K = 10


def lag_feature_frame(trips: DataFrame, lags=(1, 24)) -> DataFrame:
    """Filled hourly grid with lag features, warm-up rows dropped."""
    panel = aggregate(trips, fill_missing_hours=True)
    names = [f"lag_{k}h" for k in lags]
    return panel.select("*", *lag_columns(lags)).dropna(subset=names)


def last_hour_rows(df: DataFrame, time: str = "hour") -> DataFrame:
    """Rows at the latest hour (the max is a scalar subquery)."""
    return df.where(F.col(time) == df.agg(F.max(time)).scalar())


def top_k_forecast(model, rows: DataFrame, dim: DataFrame | None = None,
                   k: int = DEFAULT_TOP_K) -> DataFrame:
    """Top-``k`` zones by predicted demand at the last hour, with names.

    Predictions are rounded to 6 digits before ranking and ties go to the
    smaller zone id, so the ranking is deterministic.
    """
    scored = model.transform(last_hour_rows(rows)) \
                  .withColumn("predicted_demand", F.round("prediction", 6))
    top = scored.orderBy(F.desc("predicted_demand"), "zone_id").limit(k)
    if dim is not None:
        resolver = dim if isinstance(dim, ZoneResolver) else ZoneResolver(dim)
        top = resolver.label(top, "zone_id", "zone_name")
        name = F.col("zone_name")
    else:
        name = F.format_string("zone %d", F.col("zone_id"))
    rank = F.row_number().over(Window.orderBy(F.desc("predicted_demand"), "zone_id"))
    return top.select(rank.alias("rank"), "zone_id", name.alias("zone_name"), "hour",
                      "predicted_demand", F.col("demand").alias("actual_demand"))


@dataclass
class ForecastReport:
    metrics: DataFrame
    model_table: DataFrame
    top_k: DataFrame
    forecaster: DemandForecaster
    models: MultiModelForecaster


def forecast_report(trips: DataFrame, dim: DataFrame | None = None, *, top_k: int = DEFAULT_TOP_K,
                    train_frac: float = 0.8, model_names=None,
                    materialize: str = "parquet") -> ForecastReport:
    """Run the whole forecasting flow; the feature frame is materialised once.

    Returns the OLS-vs-baseline metrics row, the per-model comparison table
    and the top-K table (all DataFrames).
    """
    feats = materialized(lag_feature_frame(trips), materialize)
    train, test = time_split(feats, train_frac)
    names = list(model_names or ("linear", "ridge", "random_forest"))
    if "linear" not in names:
        names.insert(0, "linear")
    multi = MultiModelForecaster(model_names=names).fit(train)
    ols = DemandForecaster.from_model(multi.models["linear"])   # same OLS fit, not refitted
    metrics = evaluate_model(ols, test, include_mape=True)
    table = model_comparison(multi, test)
    return ForecastReport(metrics, table, top_k_forecast(ols, feats, dim, top_k), ols, multi)
