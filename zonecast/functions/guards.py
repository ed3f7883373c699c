"""The guards' findings as a table, for callers that want a report instead of an exception."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.columns import is_numeric_type, is_time_type

_ROW = "array<struct<guard:string,column:string,passed:boolean,n_bad:bigint>>"


def guard_report(df: DataFrame, *, required=(), numeric=(), times=(), complete=()) -> DataFrame:
    """``guard, column, passed, n_bad``: one row per guard and column, from the schema and one aggregate.

    *required*: the column is there.  *numeric*, *time*: it is there and has
    such a type.  *complete*: how many rows are null in the column, passed if
    any is not; and, with column ``*``, how many rows are null in any of the
    ``complete`` columns, passed if a row is left - the guard against an empty
    training or evaluation set.  ``n_bad`` is null where the schema decides;
    a ``complete`` column that is missing fails with a null ``n_bad``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}

    def row(guard: str, column: str, passed, n_bad=None) -> Column:
        return F.struct(F.lit(guard).alias("guard"), F.lit(column).alias("column"),
                        (passed if isinstance(passed, Column) else F.lit(passed)).alias("passed"),
                        (F.lit(None) if n_bad is None else n_bad).cast("bigint").alias("n_bad"))
    rows = [row("required", c, c in types) for c in required]
    rows += [row("numeric", c, c in types and is_numeric_type(types[c])) for c in numeric]
    rows += [row("time", c, c in types and is_time_type(types[c])) for c in times]
    there = [c for c in complete if c in types]
    aggregates = [F.count(F.lit(1)).alias("n")] + [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(there)]
    if complete and len(there) == len(list(complete)):
        whole = F.lit(True)
        for c in there:
            whole = whole & F.col(f"`{c}`").isNotNull()
        aggregates.append(F.count_if(whole).alias("whole"))
    for c in complete:
        if c in there:
            have = F.col(f"c{there.index(c)}")
            rows.append(row("complete", c, have > 0, F.col("n") - have))
        else:
            rows.append(row("complete", c, False))
    if complete:
        rows.append(row("complete", "*", F.col("whole") > 0, F.col("n") - F.col("whole")) if len(there) == len(list(complete))
                    else row("complete", "*", False))
    one = df.agg(*aggregates)
    return one.select(F.inline(F.array(*rows).cast(_ROW)))
