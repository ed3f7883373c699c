"""Models that are plain column expressions: scored without any Spark ML state."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.columns import require_columns
from zonecast.ml.forecaster import saved_versions


class ColumnModel:
    """Any prediction that a column expression can state, with the protocol that scoring asks for.

    ``build`` gets the DataFrame's feature columns (double) by name and
    returns the prediction.  Rows that lack a feature are dropped, as the
    fitted models do.
    """

    def __init__(self, feature_columns, build, target_column: str = "demand"):
        self.feature_columns, self.target_column, self._build = list(feature_columns), target_column, build

    def expression(self) -> Column:
        return self._build({c: F.col(c).cast("double") for c in self.feature_columns})

    def transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.feature_columns, "DataFrame")
        return df.dropna(subset=self.feature_columns).withColumn("prediction", self.expression())

    predict = transform


class LinearColumns(ColumnModel):
    """A linear model from its coefficients, as ``DemandForecaster.coefficients`` names them."""

    def __init__(self, coefficients: dict[str, float], target_column: str = "demand"):
        names = [c.removeprefix("coef_") for c in coefficients if c != "intercept"]

        def build(columns):
            total = F.lit(float(coefficients.get("intercept", 0.0)))
            for n in names:
                total = total + F.lit(float(coefficients[f"coef_{n}"])) * columns[n]
            return total
        super().__init__(names, build, target_column)

    @classmethod
    def from_saved(cls, path: str, version: str | None = None) -> LinearColumns:
        """From the contract row of a saved forecaster; the pipeline beside it is not read."""
        done = saved_versions(path)
        if done is None:
            raise FileNotFoundError(f"no contract below {path}")
        if version is not None:
            done = done.where(F.col("version") == version)
        row = done.orderBy(F.desc("place"), "version").first()
        if row is None:
            raise FileNotFoundError(f"no committed version {version or ''} below {path}")
        contract = json.loads(row["contract"])
        return cls(contract["coefficients"], contract["target_column"])
