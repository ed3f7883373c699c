"""Regressors on Spark ML with the reference's estimator semantics.

* ``linear``: ordinary least squares with intercept — ``LinearRegression``
  with the normal-equation solver and no penalty (standardisation does not
  change an unpenalised fit).
* ``ridge``: least squares with an L2 penalty ``alpha`` on *standardised*
  features (population std), intercept unpenalised.  Spark's objective is
  ``1/(2n)·RSS + regParam/2·||w_std||²`` with ``regParam`` expressed on a
  label scaled by its own std, so ``regParam = alpha·std_pop(y)/n`` gives
  the same coefficients.  ``n`` and ``std_pop(y)`` come from one aggregate.
* ``forest``: ``RandomForestRegressor`` with 50 trees, depth 10, every
  feature considered at each split, fixed seed.  Where many training rows are
  mostly repeats, its trees are fitted to the distinct rows, each weighted by
  its number in the tree's bootstrap sample (see :func:`bootstrap_counts`).

Feature vectors are assembled inside the pipeline, so a fitted model scores
any frame that has the feature columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.columns import require_columns, require_numeric
from zonecast.session import checkpoint_dir

# Model names and hyper-parameters.
SUPPORTED_MODELS = ("linear", "ridge", "random_forest")
DEFAULT_FEATURE_COLUMNS = ("lag_1h", "lag_24h")
DEFAULT_TARGET = "demand"
DEFAULT_RANDOM_STATE = 42
RIDGE_ALPHA = 1.0
FOREST_TREES = 50
FOREST_DEPTH = 10
FOREST_MAX_BINS = 256
FOREST_THREADS = 8           # trees of distinct rows that are fitted at a time


def check_model_names(names) -> list[str]:
    names = list(names)
    if not names:
        raise ValueError("model_names must not be empty")
    unknown = [n for n in names if n not in SUPPORTED_MODELS]
    if unknown:
        raise ValueError(f"Unknown model(s) {unknown}; supported: {SUPPORTED_MODELS}")
    return names


def training_rows(df: DataFrame, features, target) -> DataFrame:
    """Rows complete in the features (a null target still fails the fit)."""
    require_columns(df, list(features) + [target], "training frame")
    require_numeric(df, list(features) + [target])
    return df.dropna(subset=list(features)).withColumn(target, F.col(target).cast("double"))


def _assembler(features) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


@dataclass
class ModelSpec:
    """An unfitted model: name, columns and hyper-parameters."""

    name: str
    features: tuple = DEFAULT_FEATURE_COLUMNS
    target: str = DEFAULT_TARGET
    scaler: bool = True
    random_state: int = DEFAULT_RANDOM_STATE
    alpha: float = RIDGE_ALPHA
    prediction_col: str = "prediction"
    extra: dict = field(default_factory=dict)

    def _regressor(self, n: int | None = None, y_std: float | None = None):
        common = dict(featuresCol="features", labelCol=self.target,
                      predictionCol=self.prediction_col)
        if self.name == "linear":
            return LinearRegression(solver="normal", regParam=0.0, elasticNetParam=0.0,
                                    fitIntercept=True, **common)
        if self.name == "ridge":
            reg = 0.0 if not n or not y_std else self.alpha * y_std / n
            return LinearRegression(solver="normal", regParam=reg, elasticNetParam=0.0,
                                    fitIntercept=True, standardization=self.scaler, **common)
        if self.name == "random_forest":
            # each pass walks the trees from the root: at this depth that is
            # faster than keeping every row's node in every tree, and needs
            # neither memory nor checkpoints for them
            return RandomForestRegressor(numTrees=FOREST_TREES, maxDepth=FOREST_DEPTH,
                                         seed=self.random_state, featureSubsetStrategy="all",
                                         maxBins=FOREST_MAX_BINS, cacheNodeIds=False, **common)
        raise ValueError(f"Unknown model {self.name!r}; supported: {SUPPORTED_MODELS}")

    def fit(self, df: DataFrame) -> PipelineModel:
        """Fit on rows complete in the features.

        One aggregate gives the row count — the empty-set check — and, for
        ridge, the label spread of the penalty.  The normal-equation solvers
        then need one more pass; only the forest, which passes over the rows
        once per tree level, gets them spread out and cached first.
        """
        many_passes = self.name == "random_forest"
        prepared = _prepared(df, self.features, self.target, cache=many_passes)
        with prepared as (rows, n, y_std):
            return self.fit_prepared(rows, n, y_std, prepared.distinct)

    def fit_prepared(self, rows: DataFrame, n: int, y_std: float, distinct: DataFrame | None = None) -> PipelineModel:
        """Fit on rows already cleaned by :func:`training_rows` and summarised; a forest on their ``distinct`` ones, if given."""
        checkpoint_dir(rows.sparkSession)
        if distinct is not None and self.name == "random_forest":
            return self._fit_distinct(distinct)
        pipe = Pipeline(stages=[_assembler(self.features), self._regressor(n, y_std)])
        return pipe.fit(rows)

    def _fit_distinct(self, distinct: DataFrame) -> PipelineModel:
        """The forest whose trees are fitted one by one, to the distinct rows weighted by the tree's bootstrap counts."""
        assembler, forest = _assembler(self.features), self._regressor()
        points = assembler.transform(bootstrap_counts(distinct, [*self.features, self.target], FOREST_TREES, self.random_state))
        points = points.select("features", self.target, "_counts").persist(StorageLevel.MEMORY_AND_DISK)
        one = DecisionTreeRegressor(maxDepth=FOREST_DEPTH, maxBins=FOREST_MAX_BINS, seed=self.random_state, weightCol="_weight",
                                    featuresCol="features", labelCol=self.target, predictionCol=self.prediction_col)

        def fit(tree):
            weight = F.get("_counts", F.lit(tree)).cast("double")
            return one.fit(points.withColumn("_weight", weight).where("_weight > 0"))
        try:
            with ThreadPool(FOREST_THREADS) as pool:
                trees = pool.map(inheritable_thread_target(distinct.sparkSession)(fit), range(FOREST_TREES), chunksize=1)
        finally:
            points.unpersist()
        # Spark ML's own forest model around the fitted trees
        jvm, gateway = distinct.sparkSession._jvm, distinct.sparkSession.sparkContext._gateway
        array = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
        for i, tree in enumerate(trees):
            array[i] = tree._java_obj
        model = jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(forest.uid, array, len(self.features))
        model = forest._copyValues(forest._create_model(model))
        model._transfer_params_to_java()
        return PipelineModel([assembler, model])


def bootstrap_counts(distinct: DataFrame, values, n_trees: int, seed: int) -> DataFrame:
    """Distinct rows with ``_counts``: how often each tree's bootstrap sample holds them.

    A bootstrap draws every training row a Poisson(1) number of times, so the
    ``_n`` equal rows behind a distinct one come to a Poisson(``_n``) number.
    The draws follow from the row's values and the seed alone, so they are the
    same on any cluster.
    """
    schema = distinct.select(*values)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.schema.fields)

    def draw(batches):
        for batch in batches:
            keys, n = batch.column("_key").to_numpy().view(np.uint64), batch.column("_n").to_numpy()
            counts = np.empty((len(n), n_trees), np.int64)
            for i in range(len(n)):
                counts[i] = np.random.Generator(np.random.Philox(key=[keys[i], seed % (1 << 64)])).poisson(n[i], n_trees)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * n_trees), pa.array(counts.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in values), lists], names=[*values, "_counts"])
    keyed = distinct.select(*values, "_n", F.xxhash64(*[F.col(c).cast("double") for c in values]).alias("_key"))
    return keyed.mapInArrow(draw, f"{schema}, _counts array<bigint>")


# A multi-pass fit lays its rows out in partitions of about this many: a task a
# pass and partition, so they should be worth a task, and there should be enough
# of them for a cluster.  Their number follows from the row count alone and a
# row's place from its values, so the same rows and seed give the same model on
# any cluster (tree bagging draws by partition and place).  Beyond
# MAX_FIT_PARTITIONS * ROWS_PER_FIT_PARTITION = 5 * 10^8 rows partitions grow instead
# of their number, which a driver has to track in every pass.
ROWS_PER_FIT_PARTITION = 50_000
MAX_FIT_PARTITIONS = 10_000
# From this many rows on, a forest is fitted to the distinct rows, if the rows
# are at least DISTINCT_PAYS times as many.  Fewer rows are passed over quickly
# and keep Spark's own row sample.
DISTINCT_FROM = 2_000_000
DISTINCT_PAYS = 20


class _prepared:
    """Context: cleaned training rows with their count and label std.

    One aggregate gives the row count (the empty-set check) and the label's
    population std (the ridge penalty scale).  With ``cache`` (multi-pass
    solvers) the rows are dealt by the hash of all their values, sorted within
    partitions, and their features and label cached, unless their features and
    label are mostly repeats: then ``distinct`` holds each combination once,
    with its number of rows ``_n``, and the rows are left where they are.
    """

    def __init__(self, df: DataFrame, features, target, *, cache: bool = True):
        self.features, self.target = list(features), target
        self.rows = training_rows(df, features, target)
        self.cache = cache
        self.cached = None
        self.distinct = None

    def __enter__(self):
        read = list(dict.fromkeys([*self.features, self.target]))
        different = F.approx_count_distinct(F.xxhash64(*read)) if self.cache else F.lit(None)
        stats = self.rows.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(self.target).alias("s"), different.alias("d")).first()
        n = stats["n"]
        if not n:
            raise ValueError("training set is empty after dropping rows with missing "
                             f"features {self.features}")
        rows = self.rows
        if not self.cache:
            return rows, n, stats["s"]
        if n >= DISTINCT_FROM and n >= DISTINCT_PAYS * stats["d"]:
            counted = rows.groupBy(*read).agg(F.count(F.lit(1)).alias("_n"))
            parts = max(1, -(-stats["d"] // ROWS_PER_FIT_PARTITION))
            # dealt and ordered by their values: the same rows are fitted in the same order on any cluster
            dealt = counted.repartition(parts, *read).sortWithinPartitions(*read)
            self.cached = self.distinct = dealt.persist(StorageLevel.MEMORY_AND_DISK)
            return rows, n, stats["s"]
        parts = max(1, min(MAX_FIT_PARTITIONS, -(-n // ROWS_PER_FIT_PARTITION)))
        plain = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.AtomicType)]
        # dealt and ordered by all values (equal feature vectors are many), kept with those that the fit reads
        rows = rows.repartition(parts, *plain).sortWithinPartitions(*plain).select(*read)
        self.cached = rows.persist(StorageLevel.MEMORY_AND_DISK)
        return self.cached, n, stats["s"]

    def __exit__(self, *exc):
        if self.cached is not None:
            self.cached.unpersist()
        return False


def make_pipeline(model_name: str = "linear", *, scaler: bool = True,
                  random_state: int = DEFAULT_RANDOM_STATE,
                  features=DEFAULT_FEATURE_COLUMNS, target: str = DEFAULT_TARGET) -> ModelSpec:
    check_model_names([model_name])
    return ModelSpec(model_name, tuple(features), target, scaler, random_state)


def train_models(df: DataFrame, model_names=None, *, scaler: bool = True,
                 random_state: int = DEFAULT_RANDOM_STATE,
                 features=DEFAULT_FEATURE_COLUMNS, target: str = DEFAULT_TARGET,
                 ) -> dict[str, PipelineModel]:
    """Fit one pipeline per model name on the same cleaned, cached rows."""
    names = check_model_names(SUPPORTED_MODELS if model_names is None else model_names)
    specs = {n: make_pipeline(n, scaler=scaler, random_state=random_state,
                              features=features, target=target) for n in names}
    prepared = _prepared(df, features, target)
    with prepared as (rows, n, y_std):
        return {name: spec.fit_prepared(rows, n, y_std, prepared.distinct) for name, spec in specs.items()}


def linear_coefficients(model: PipelineModel, features) -> dict[str, float]:
    lr = model.stages[-1]
    out = {"intercept": float(lr.intercept)}
    for f, c in zip(features, lr.coefficients.toArray()):
        out[f"coef_{f}"] = float(c)
    return out
