"""Scoring: model and same-hour-yesterday baseline on one common row set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.columns import require_columns
from zonecast.functions.metrics import DEFAULT_EPSILON, fail_if_empty, mae, mape, rmse

BASELINE_COLUMN = "lag_24h"


def naive_baseline(df: DataFrame, *, extra_dropna_columns=None) -> DataFrame:
    """Rows complete in ``lag_1h``, ``lag_24h`` (+ extras) with ``baseline = lag_24h``."""
    cols = list(dict.fromkeys(["lag_1h", "lag_24h"] + list(extra_dropna_columns or [])))
    require_columns(df, cols, "feature frame")
    return df.dropna(subset=cols).withColumn("baseline", F.col(BASELINE_COLUMN).cast("double"))


def evaluate_model(model, df: DataFrame, *, include_mape: bool = False,
                   epsilon: float = DEFAULT_EPSILON) -> DataFrame:
    """One row: ``model_mae, model_rmse, baseline_mae, baseline_rmse`` (+ MAPEs).

    Rows missing any model feature, the baseline or the target are dropped
    once, then model and baseline are scored on exactly those rows, all
    metrics in a single aggregate.  ``model`` needs ``feature_columns`` and a
    ``transform`` or ``predict`` method returning the rows with a
    ``prediction`` column (``target_column`` defaults to ``demand``).
    """
    target = getattr(model, "target_column", "demand")
    required = list(dict.fromkeys(list(model.feature_columns) + [BASELINE_COLUMN, target]))
    require_columns(df, required, "evaluation frame")
    score = getattr(model, "transform", None) or model.predict
    rows = score(df.dropna(subset=required))
    y, p, b = F.col(target), F.col("prediction"), F.col(BASELINE_COLUMN)
    cols = [mae(y, p).alias("model_mae"), rmse(y, p).alias("model_rmse"),
            mae(y, b).alias("baseline_mae"), rmse(y, b).alias("baseline_rmse")]
    if include_mape:
        cols += [mape(y, p, epsilon).alias("model_mape"), mape(y, b, epsilon).alias("baseline_mape")]
    agg = rows.agg(*cols, F.count(F.lit(1)).alias("n"))
    agg = fail_if_empty(agg, f"Evaluation set is empty after dropping rows with nulls in {required}")
    return agg.drop("n")


def model_comparison(multi, df: DataFrame, *, epsilon: float = DEFAULT_EPSILON) -> DataFrame:
    """``(model, mae, rmse, mape)`` per fitted model plus ``baseline-lag24``.

    All models are scored on the same rows (complete in features, baseline
    and target) in one aggregate, then unpivoted.
    """
    target = multi.target_column
    required = list(dict.fromkeys(list(multi.feature_columns) + [BASELINE_COLUMN, target]))
    require_columns(df, required, "evaluation frame")
    scored = multi.transform_all(df.dropna(subset=required))
    preds = {name: f"pred_{name}" for name in multi.models}
    preds["baseline-lag24"] = BASELINE_COLUMN
    aggs = []
    for i, (name, col) in enumerate(preds.items()):
        aggs += [mae(target, col).alias(f"mae_{i}"), rmse(target, col).alias(f"rmse_{i}"),
                 mape(target, col, epsilon).alias(f"mape_{i}")]
    wide = scored.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(name).alias("model"), F.col(f"mae_{i}").alias("mae"),
                              F.col(f"rmse_{i}").alias("rmse"), F.col(f"mape_{i}").alias("mape"))
                     for i, name in enumerate(preds)])
    return wide.select(F.explode(rows).alias("r")).select("r.*")
