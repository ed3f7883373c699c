"""Plan-time schema guards.  They read ``df.schema`` only, so no job runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "DataFrame") -> None:
    """Raise ``ValueError`` naming every required column that is absent."""
    have = set(df.columns)
    missing = [c for c in dict.fromkeys(columns) if c not in have]
    if missing:
        raise ValueError(f"{what} missing required columns: {missing}")


def is_time_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType))


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def require_numeric(df: DataFrame, columns: Iterable[str]) -> None:
    bad = [c for c in columns if not is_numeric_type(df.schema[c].dataType)]
    if bad:
        raise ValueError(f"feature columns must be numeric, got non-numeric: {bad}")


def positive_ints(values, name: str) -> list[int]:
    """Validate a non-empty sequence of positive Python ints (bools rejected)."""
    if values is None:
        raise ValueError(f"{name} must not be None")
    vals = list(values)
    if not vals:
        raise ValueError(f"{name} must not be empty")
    for v in vals:
        if isinstance(v, bool) or not isinstance(v, int) or v <= 0:
            raise ValueError(f"{name} must be positive integers, got {v!r}")
    return vals
