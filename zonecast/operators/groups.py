"""Per-group user functions over Arrow batches (no per-row Python).

Meant for the hourly panel, where a group (one zone) holds at most one row
per hour, so every group fits one task however hot the zone is.  Built-in
features (lags, rolling statistics) are native window expressions and should
not go through this path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.columns import require_columns


def _whole_groups(func, group_column: str, out_schema):
    """A ``mapInArrow`` function that calls ``func`` on every group of batches sorted by it.

    A batch is converted to pandas once, cut at the groups, and the results
    of its groups are converted back together: with many small groups that
    conversion, not ``func``, is the cost.  Nested, so that it is shipped by
    value and workers need not have this package.
    """
    def run(batches):
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        def results(frame):
            keys = frame[group_column].to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            done = [func(frame.iloc[lo:hi].reset_index(drop=True)) for lo, hi in zip([0, *cuts], [*cuts, len(frame)])]
            out = pd.concat(done, ignore_index=True) if len(done) > 1 else done[0]
            return pa.RecordBatch.from_pandas(out, schema=out_schema, preserve_index=False)
        rest = []                                   # frames of the group that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            frame = pa.Table.from_batches([batch]).to_pandas(coerce_temporal_nanoseconds=True)
            keys = frame[group_column].to_numpy()
            new = np.flatnonzero(keys != keys[0])
            if rest and rest[-1][group_column].iloc[-1] != keys[0]:
                yield results(pd.concat(rest, ignore_index=True))
                rest = []
            if len(new):
                last = len(keys) - 1 - int(np.argmax(keys[::-1] != keys[-1])) + 1       # where the last group begins
                yield results(pd.concat([*rest, frame.iloc[:last]], ignore_index=True) if rest else frame.iloc[:last])
                rest = [frame.iloc[last:]]
            else:
                rest.append(frame)
        if rest:
            yield results(pd.concat(rest, ignore_index=True))
    return run


def apply_per_zone(df: DataFrame, func, schema: str, *, n_workers: int | None = None,
                   group_column: str = "zone_id", time_column: str = "hour") -> DataFrame:
    """Apply ``func(pandas.DataFrame) -> pandas.DataFrame`` to each group.

    Each group arrives as a frame of its own, sorted by ``time_column`` (times
    with nanoseconds, as pandas has them).  ``func`` may add columns
    or change the row count; ``schema`` is its output as DDL.  Null groups are
    dropped first.  A group is one pandas frame in one task, so ``df`` must be
    aggregated so far that its groups are bounded - ``aggregate(trips)`` rather
    than raw trips, of which a hot zone may have a third.
    ``n_workers`` sets the number of partitions of the group shuffle; without
    it a frame that is partitioned by group already is not shuffled again.
    The result does not depend on it.
    """
    require_columns(df, (group_column, time_column), "DataFrame")
    if not callable(func):
        raise ValueError("func must be callable")
    if n_workers is not None and (isinstance(n_workers, bool) or not isinstance(n_workers, int)
                                  or n_workers <= 0):
        raise ValueError(f"n_workers must be a positive integer or None, got {n_workers!r}")
    from pyspark.sql.pandas.types import to_arrow_schema
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = df.where(F.col(group_column).isNotNull())
    if n_workers is not None:
        rows = rows.repartition(n_workers, group_column)
    # a window over the group asks for the rows of a group together, in order of time, wherever they are not yet
    place = F.row_number().over(Window.partitionBy(group_column).orderBy(time_column))
    rows = rows.withColumn("_place", place).where(F.col("_place") > 0)
    return rows.drop("_place").mapInArrow(_whole_groups(func, group_column, to_arrow_schema(out)), out)
