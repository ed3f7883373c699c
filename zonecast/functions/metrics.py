"""Forecast error metrics as aggregate expressions (one pass, one row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_EPSILON = 1e-9


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mae(y: Column | str, p: Column | str) -> Column:
    return F.avg(F.abs(_c(y).cast("double") - _c(p).cast("double")))


def rmse(y: Column | str, p: Column | str) -> Column:
    d = _c(y).cast("double") - _c(p).cast("double")
    return F.sqrt(F.avg(d * d))


def mape(y: Column | str, p: Column | str, epsilon: float = DEFAULT_EPSILON) -> Column:
    """Mean of ``|y-p| / (|y| + eps)``, a fraction (not a percentage)."""
    if epsilon < 0:
        raise ValueError("epsilon must be non-negative")
    yy = _c(y).cast("double")
    return F.avg(F.abs(yy - _c(p).cast("double")) / (F.abs(yy) + F.lit(float(epsilon))))


def metric_columns(y: str, p: str, prefix: str = "", include_mape: bool = False,
                   epsilon: float = DEFAULT_EPSILON) -> list[Column]:
    cols = [mae(y, p).alias(f"{prefix}mae"), rmse(y, p).alias(f"{prefix}rmse")]
    if include_mape:
        cols.append(mape(y, p, epsilon).alias(f"{prefix}mape"))
    return cols


def regression_metrics(df: DataFrame, label: str, prediction: str, *,
                       include_mape: bool = True, epsilon: float = DEFAULT_EPSILON) -> DataFrame:
    """One row ``mae, rmse[, mape], n`` over rows where both columns are set.

    An empty row set fails inside the same job (no separate count pass).
    """
    rows = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    agg = rows.agg(*metric_columns(label, prediction, "", include_mape, epsilon),
                   F.count(F.lit(1)).alias("n"))
    return fail_if_empty(agg, "metrics need at least one row with a label and a prediction")


def fail_if_empty(one_row: DataFrame, message: str, n_col: str = "n") -> DataFrame:
    """Raise (at execution) when the aggregate counted no rows."""
    cols = [F.when(F.col(n_col) == 0, F.raise_error(F.lit(message))).otherwise(F.col(c)).alias(c)
            if c != n_col else F.col(c) for c in one_row.columns]
    return one_row.select(*cols)
