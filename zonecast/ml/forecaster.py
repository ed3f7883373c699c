"""Forecaster objects: a single OLS forecaster and a multi-model holder."""

from __future__ import annotations

import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.columns import require_columns
from zonecast.ml.models import (DEFAULT_FEATURE_COLUMNS, DEFAULT_RANDOM_STATE,
                                DEFAULT_TARGET, SUPPORTED_MODELS, check_model_names,
                                linear_coefficients, make_pipeline, train_models)

_CONTRACT = "zonecast_contract"
_VERSIONS = "versions"


class DemandForecaster:
    """OLS on lag features; ``transform`` appends a ``prediction`` column."""

    def __init__(self, feature_columns=DEFAULT_FEATURE_COLUMNS, target_column: str = DEFAULT_TARGET):
        self.feature_columns = list(feature_columns)
        self.target_column = target_column
        self.model: PipelineModel | None = None

    def fit(self, df: DataFrame) -> "DemandForecaster":
        require_columns(df, self.feature_columns + [self.target_column], "training frame")
        self.model = make_pipeline("linear", features=self.feature_columns,
                                   target=self.target_column).fit(df)
        return self

    @classmethod
    def from_model(cls, model: PipelineModel, feature_columns=DEFAULT_FEATURE_COLUMNS,
                   target_column: str = DEFAULT_TARGET) -> "DemandForecaster":
        """Wrap an already fitted linear pipeline (e.g. one of a multi-model fit)."""
        out = cls(feature_columns, target_column)
        out.model = model
        return out

    def _fitted(self) -> PipelineModel:
        if self.model is None:
            raise RuntimeError("model is not fitted; call fit() first")
        return self.model

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows complete in the features, with ``prediction`` (row-aligned)."""
        model = self._fitted()
        require_columns(df, self.feature_columns, "DataFrame")
        return model.transform(df.dropna(subset=self.feature_columns)).drop("features")

    predict = transform

    def coefficients(self) -> dict[str, float]:
        return linear_coefficients(self._fitted(), self.feature_columns)

    def save(self, path: str) -> str:
        """Add a version below ``path`` and return its name.

        The pipeline goes to a folder of its own; the contract row (column
        names, coefficients, place in the order of versions) is appended
        after it and is what commits the version.  A save that is broken off
        leaves the versions before it untouched, and readers never see half
        of one.
        """
        model = self._fitted()
        spark = SparkSession.getActiveSession()
        version = uuid.uuid4().hex
        done = saved_versions(path)
        place = 1 if done is None else done.agg(F.max("place")).first()[0] + 1
        model.write().save(f"{path}/{_VERSIONS}/{version}")
        contract = json.dumps({"feature_columns": self.feature_columns, "target_column": self.target_column,
                               "coefficients": self.coefficients()})
        row = spark.range(1).select(F.lit(version).alias("version"), F.lit(place).cast("bigint").alias("place"), F.lit(contract).alias("contract"))
        row.coalesce(1).write.mode("append").json(f"{path}/{_CONTRACT}")
        return version

    def load(self, path: str, version: str | None = None) -> "DemandForecaster":
        """Restore the latest committed version, or the one named; its contract overrides constructor columns."""
        done = saved_versions(path)
        if done is None:         # saved without a contract: the constructor's columns hold
            self.model = PipelineModel.load(f"{path}/pipeline")
            return self
        if version is not None:
            done = done.where(F.col("version") == version)
        row = done.orderBy(F.desc("place"), "version").first()
        if row is None:
            raise FileNotFoundError(f"no committed version {version or ''} below {path}")
        self.model = PipelineModel.load(f"{path}/{_VERSIONS}/{row['version']}")
        c = json.loads(row["contract"])
        self.feature_columns = list(c["feature_columns"])
        self.target_column = c["target_column"]
        return self


def saved_versions(path: str) -> DataFrame | None:
    """``version, place, contract`` of every committed version, or None where there is no contract table."""
    try:
        return SparkSession.getActiveSession().read.schema("version string, place bigint, contract string").json(f"{path}/{_CONTRACT}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class MultiModelForecaster:
    """Fit several model families on the same rows and score them side by side."""

    def __init__(self, feature_columns=DEFAULT_FEATURE_COLUMNS, target_column: str = DEFAULT_TARGET,
                 model_names=None, *, scaler: bool = True,
                 random_state: int = DEFAULT_RANDOM_STATE):
        self.feature_columns = list(feature_columns)
        self.target_column = target_column
        # an empty list falls back to every model (truthiness), unlike train_models
        self.model_names = check_model_names(model_names or SUPPORTED_MODELS)
        self.scaler = scaler
        self.random_state = random_state
        self.models: dict[str, PipelineModel] = {}

    def fit(self, df: DataFrame) -> "MultiModelForecaster":
        self.models = train_models(df, self.model_names, scaler=self.scaler,
                                   random_state=self.random_state,
                                   features=self.feature_columns, target=self.target_column)
        return self

    def transform(self, df: DataFrame, model_name: str = "linear") -> DataFrame:
        if not self.models:
            raise RuntimeError("models are not fitted; call fit() first")
        if model_name not in self.models:
            raise ValueError(f"model {model_name!r} was not trained; trained: {sorted(self.models)}")
        require_columns(df, self.feature_columns, "DataFrame")
        return self.models[model_name].transform(df.dropna(subset=self.feature_columns)).drop("features")

    predict = transform

    def transform_all(self, df: DataFrame) -> DataFrame:
        """One ``pred_{name}`` column per model on the same rows (one plan)."""
        if not self.models:
            raise RuntimeError("models are not fitted; call fit() first")
        out = df.dropna(subset=self.feature_columns)
        for name, model in self.models.items():
            out = model.transform(out).withColumnRenamed("prediction", f"pred_{name}").drop("features")
        return out
