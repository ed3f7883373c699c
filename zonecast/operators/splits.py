"""Time-respecting splits: train/test cut on distinct hours, expanding CV folds.

Only the *distinct times* are ever ordered in one partition (at most 8,784 a
year at hour grain, 527,040 at minute grain); the rows themselves stay distributed.  Row positions for
position-based folds come from a range-partitioned, checkpointed copy and
per-partition offsets, never from an unpartitioned ``row_number``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.columns import require_columns
from zonecast.functions.time import ntz_literal
from zonecast.operators.demand import materialized


def _check_frac(train_frac: float) -> float:
    if isinstance(train_frac, bool) or not isinstance(train_frac, (int, float)):
        raise ValueError("train_frac must be a number")
    if not 0.0 < float(train_frac) < 1.0:
        raise ValueError(f"train_frac must be in (0, 1), got {train_frac!r}")
    return float(train_frac)


def hour_index(df: DataFrame, time: str = "hour") -> DataFrame:
    """Distinct hours with their 0-based rank and the number of distinct hours."""
    hours = df.select(time).where(F.col(time).isNotNull()).distinct()
    n_hours = hours.agg(F.count(F.lit(1))).scalar()
    return hours.select(time, (F.row_number().over(Window.orderBy(time)) - 1).alias("hour_idx"),
                        n_hours.alias("n_hours"))


def split_cut(df: DataFrame, train_frac: float = 0.8, time: str = "hour") -> DataFrame:
    """At most one row ``cut_hour``: the first test hour, ``hours[max(1, int(n*frac))]``.

    Empty when there are fewer than two distinct hours (everything is train).
    The distinct hours are found in one pass and ordered as one array value.
    """
    frac = _check_frac(train_frac)
    hours = df.select(time).where(F.col(time).isNotNull()).distinct().agg(F.sort_array(F.collect_list(time)).alias("h"))
    at = F.greatest(F.lit(1), F.floor(F.size("h") * F.lit(frac)).cast("int"))
    return hours.where(F.size("h") >= 2).select(F.get("h", at).alias("cut_hour"))


def label_time_split(df: DataFrame, train_frac: float = 0.8, time: str = "hour") -> DataFrame:
    """Add ``split`` = 'train' (hour < cut) or 'test' (hour >= cut).

    The cut is a scalar subquery (one value, null when there is none).
    """
    require_columns(df, (time,), "DataFrame")
    cut = split_cut(df, train_frac, time).scalar()
    return df.withColumn("split", F.when(cut.isNull() | (F.col(time) < cut), F.lit("train"))
                                   .otherwise(F.lit("test")))


def time_split(df: DataFrame, train_frac: float = 0.8, time: str = "hour"):
    """``(train, test)`` with no hour in both; train hours precede test hours.

    The cut is fetched once (one value from the distinct-hour table), so both
    halves are plain time predicates (pushed down where ``df`` is a table
    scan), and every later pass over them (model fits) skips the cut.
    """
    require_columns(df, (time,), "DataFrame")
    row = split_cut(df, train_frac, time).first()
    cut = None if row is None else row["cut_hour"]
    if cut is None:                      # fewer than two hours: all train
        return df, df.where(F.lit(False))
    bound = ntz_literal(cut) if isinstance(df.schema[time].dataType, T.TimestampNTZType) else F.lit(cut)
    return df.where(F.col(time) < bound), df.where(F.col(time) >= bound)


# ------------------------------------------------------------------ CV folds

def _check_cv(n_splits) -> int:
    if isinstance(n_splits, bool) or not isinstance(n_splits, int) or n_splits < 2:
        raise ValueError(f"n_splits has to be a whole number, 2 or more, not {n_splits!r}")
    return n_splits


def fold_edges(n: int, k: int) -> list[int]:
    """The ``k + 1`` positions at which the test blocks of ``k`` expanding folds begin and end.

    All test blocks have ``n // (k + 1)`` positions (one at least) and the
    last one ends at ``n``, so fold ``i`` tests ``[edge[i], edge[i + 1])`` and
    trains on everything before ``edge[i]``.
    """
    block = max(1, n // (k + 1))
    return [n - block * left for left in range(k, -1, -1)]


def time_series_cv_split(n_samples: int, n_splits: int = 5):
    """``(train, test)`` of every fold as ``range`` objects over the time-ordered positions.

    Nothing is built per position; :func:`cv_folds` applies the same edges
    to a DataFrame.
    """
    k = _check_cv(n_splits)
    if isinstance(n_samples, bool) or not isinstance(n_samples, int) or n_samples < 1:
        raise ValueError(f"number of samples has to be a whole number above 0, not {n_samples!r}")
    if n_samples <= k:
        raise ValueError(_too_few(k, n_samples))
    edges = fold_edges(n_samples, k)
    return ((range(begin), range(begin, end)) for begin, end in zip(edges, edges[1:]))


def _too_few(k: int, n) -> str:
    return f"{k} folds take more than {k} samples; there are {n}"


def _edges(n: Column, k: int) -> Column:
    """:func:`fold_edges` of a count column, as an array."""
    checked = F.when(n > k, n).otherwise(F.raise_error(F.concat(F.lit(_too_few(k, "")), n.cast("string"))))
    block = F.greatest(F.lit(1).cast("bigint"), F.floor(checked / F.lit(k + 1)).cast("bigint"))
    return F.array(*[checked - block * left for left in range(k, -1, -1)])


def _fold_columns(pos: Column, edges: Column, k: int) -> dict[str, Column]:
    """Where a position is tested and from which fold on it trains."""
    passed = F.size(F.filter(edges, lambda e: e <= pos))
    return {"test_fold": F.when(passed > 0, passed - 1), "train_from": F.when(passed < k, passed)}


def fold_rows(folds: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` of one fold of :func:`cv_folds` / :func:`cv_folds_by_hour`: two filters."""
    return folds.where(F.col("train_from") <= fold), folds.where(F.col("test_fold") == fold)


def fold_summary(folds: DataFrame, n_splits: int, *aggregates) -> DataFrame:
    """``(fold, role, ...)`` from mergeable ``(name, partial, merge)`` aggregates.

    Rows are aggregated once by ``(test_fold, train_from)`` - at most
    ``n_splits + 1`` groups - and only those are merged into the folds.
    """
    parts = folds.groupBy("test_fold", "train_from").agg(*[partial.alias(name) for name, partial, _ in aggregates])
    test = F.when(F.col("test_fold").isNotNull(), F.array(F.struct(F.col("test_fold").alias("fold"), F.lit("test").alias("role"))))
    train = F.when(F.col("train_from").isNotNull(), F.transform(
        F.sequence("train_from", F.lit(n_splits - 1)), lambda f: F.struct(f.alias("fold"), F.lit("train").alias("role"))))
    none = F.array().cast("array<struct<fold:int,role:string>>")
    parts = parts.withColumn("_f", F.explode(F.concat(F.coalesce(test, none), F.coalesce(train, none))))
    return parts.groupBy(F.col("_f.fold").alias("fold"), F.col("_f.role").alias("role")).agg(
        *[merge(name).alias(name) for name, _, merge in aggregates])


def with_positions(df: DataFrame, order_cols, *, pos_col: str = "pos",
                   materialize: str = "checkpoint") -> DataFrame:
    """Add a 0-based global position in ``order_cols`` order (keys must be unique).

    Range-partition and sort within partitions, materialise (so the range
    sample cannot change between the two passes), then position = offset of
    the partition (prefix sum over the per-partition counts, one row per
    partition) + index within the partition.
    """
    cols = list(order_cols)
    require_columns(df, cols, "DataFrame")
    ranged = (df.repartitionByRange(*cols).sortWithinPartitions(*cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = materialized(ranged, materialize)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select("_pid", (F.sum("_cnt").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"))
    offsets = offsets.fillna(0, ["_off"])
    # monotonically_increasing_id = (partition index << 33) + index in partition
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (ranged.join(offsets, "_pid")
                  .select(*[F.col(c) for c in df.columns], (F.col("_off") + local).alias(pos_col)))


def cv_folds(df: DataFrame, n_splits: int = 5, order_cols=("hour", "zone_id")) -> DataFrame:
    """Each row once, with ``pos``, the fold that tests it and the first fold that trains on it.

    Positions follow ``order_cols``, time first, so no fold trains on a later
    time than it tests.  A position is the number of rows at earlier values of
    the first column (a running sum over its distinct values) plus the row's
    place among those that share it, so nothing is sorted globally and no row
    is copied; the shuffle is by time, which on a panel has one row per zone.
    ``test_fold`` is null for rows that are never tested, ``train_from`` for
    rows of the last test block.  ``order_cols`` must be unique together.
    """
    k = _check_cv(n_splits)
    time, *rest = order_cols
    require_columns(df, list(order_cols), "DataFrame")
    per = df.groupBy(time).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(time).rowsBetween(Window.unboundedPreceding, -1)
    counts = per.select(time, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                        F.sum("_n").over(Window.partitionBy()).alias("_all"))
    place = F.row_number().over(Window.partitionBy(time).orderBy(*(rest or [time]))) - 1
    out = df.withColumn("_place", place).join(counts, time)
    pos = (F.col("_before") + F.col("_place")).alias("pos")
    folds = _fold_columns(F.col("_before") + F.col("_place"), _edges(F.col("_all"), k), k)
    return out.select(*df.columns, pos, *[c.alias(name) for name, c in folds.items()])


def cv_folds_by_hour(df: DataFrame, n_splits: int = 5, time: str = "hour") -> DataFrame:
    """Panel-safe folds: the expanding-window rule applied to distinct hours.

    No hour is in two roles of one fold.  Each row is labelled once, through
    an equi-join with the (distinct-hours-sized) hour table.
    """
    k = _check_cv(n_splits)
    idx = hour_index(df, time)
    folds = _fold_columns(F.col("hour_idx"), _edges(F.col("n_hours"), k), k)
    return df.join(idx.select(time, "hour_idx", *[c.alias(name) for name, c in folds.items()]), time)
