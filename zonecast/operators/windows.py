"""Leakage-free lag and rolling features as native window expressions.

All features of one call share one ``Window.partitionBy(key).orderBy(time)``
spec, so Spark plans a single exchange + sort for all of them.  After the
hourly aggregate a zone holds at most one row per hour, so a partition by
zone is bounded by the time span, however hot the zone is.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.columns import positive_ints, require_columns


def _spec(key: str, time: str):
    return Window.partitionBy(key).orderBy(time)


def lag_columns(lags, *, key="zone_id", time="hour", target="demand"):
    w = _spec(key, time)
    return [F.lag(target, k).over(w).cast("double").alias(f"lag_{k}h") for k in lags]


def rolling_columns(windows, *, key="zone_id", time="hour", target="demand"):
    """Mean and population std over the *previous* ``w`` records (frame form).

    The frame ``ROWS BETWEEN w PRECEDING AND 1 PRECEDING`` excludes the
    current row (including it would leak the target).  Partial frames count;
    the first row of a zone has a null mean and a std of 0.0.  Spark
    re-aggregates a sliding frame for every row (O(rows × w)); integral
    targets use :func:`add_window_features`' running-sum form instead.
    """
    w = _spec(key, time)
    cols = []
    for n in windows:
        frame = w.rowsBetween(-n, -1)
        cols.append(F.avg(F.col(target).cast("double")).over(frame).alias(f"roll_mean_{n}h"))
        cols.append(F.coalesce(F.stddev_pop(F.col(target).cast("double")).over(frame),
                               F.lit(0.0)).alias(f"roll_std_{n}h"))
    return cols


# A whole number x is three limbs, x = _x2 * 2^42 + _x1 * 2^21 + _x0 with the two
# lower ones in 0 .. 2^21 - 1, so that a BIGINT holds the sum of 2^19 of the
# widest products of two limbs (2^44), and 2^21 of the usual ones (2^42).
_LIMB = 21
_PAIRS = ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2))
_SUMS = ("x0", "x1", "x2", *(f"x{i}x{j}" for i, j in _PAIRS), "n")
# up to this width c * sum(x^2) of values below 2^21 is below 2^63
_NARROW = 1 << 10
_EXACT = "decimal(38,0)"


def _limb_sums(target: str, running) -> list:
    """Running sums of the limbs, of their products and of the non-null count."""
    x = F.col(target).cast("bigint")
    mask = F.lit((1 << _LIMB) - 1).cast("bigint")
    limbs = (x.bitwiseAND(mask), F.shiftright(x, _LIMB).bitwiseAND(mask), F.shiftright(x, 2 * _LIMB))
    values = [*limbs, *[limbs[i] * limbs[j] for i, j in _PAIRS], F.when(x.isNotNull(), F.lit(1).cast("bigint"))]
    return [F.sum(v).over(running).alias(f"_{name}") for name, v in zip(_SUMS, values, strict=True)]


def _earlier_sums(windows, key, time) -> list:
    """The running sums one record and ``w + 1`` records ago, each window expression once."""
    w = _spec(key, time)
    return [F.lag(f"_{name}", n).over(w).alias(f"_{name}_{n}") for n in sorted({1, *(n + 1 for n in windows)}) for name in _SUMS]


def _rolling_from_limbs(n: int) -> list:
    """Mean and population std of a window, exact until the last division.

    The variance is ``(c * sum(x^2) - sum(x)^2) / c^2``.  Where all values are
    in 0 .. 2^21 - 1 (only the lowest limb is used) and the window is narrow,
    both terms fit a BIGINT; else the limbs are put together in DECIMAL(38,0).
    The decimals stand inside a one-element transform, which keeps them out of
    the generated code of the usual case: with them it is too long to be
    compiled, and several times slower.
    """
    def s(name):
        # a running sum is null until the first value of the zone
        zero = F.lit(0).cast("bigint")
        return F.coalesce(F.col(f"_{name}_1"), zero) - F.coalesce(F.col(f"_{name}_{n + 1}"), zero)
    c = s("n")
    small = (s("x1") == 0) & (s("x2x2") == 0) & F.lit(n <= _NARROW)        # neither can be a sum of opposite signs

    def put(parts):
        """Limb sums at their weights; a sum of negative upper limbs is negative too."""
        total = F.lit(0).cast(_EXACT)
        for name, weight in parts:
            total = (total + (s(name).cast("decimal(19,0)") * F.lit(Decimal(1 << weight))).cast(_EXACT)).cast(_EXACT)
        return total
    total = put([("x0", 0), ("x1", _LIMB), ("x2", 2 * _LIMB)])
    squares = put([(f"x{i}x{j}", _LIMB * (i + j) + (i != j)) for i, j in _PAIRS])
    wide = ((c.cast("decimal(10,0)") * squares).cast(_EXACT) - (total * total).cast(_EXACT)).cast("double")

    def apart(value):
        return F.get(F.transform(F.array(F.lit(0)), lambda _: value), F.lit(0))
    mean = F.when(c > 0, F.when(small, s("x0").cast("double")).otherwise(apart(total.cast("double"))) / c)
    spread = F.when(small, (c * s("x0x0") - s("x0") * s("x0")).cast("double")).otherwise(apart(wide))
    std = F.when(c > 0, F.sqrt(spread) / c).otherwise(F.lit(0.0))
    return [mean.alias(f"roll_mean_{n}h"), std.alias(f"roll_std_{n}h")]


def add_window_features(df: DataFrame, lags=(), windows=(), *, key="zone_id", time="hour",
                        target="demand") -> DataFrame:
    """Lags and rolling statistics in one sorted pass per zone.

    Integral targets (counts) take the running-sum form: one window operator
    computes running sums of machine words, a second one the lags and window
    differences, both on the same exchange and sort, so a row costs the same
    whatever the width.  Other targets use the frame form.  The result equals
    the frame form, nulls included, without its rounding, for sums of squares
    below 10^38 and zones of fewer than 2^19 records.
    """
    require_columns(df, (key, time, target), "demand panel")
    lag_cols = lag_columns(lags, key=key, time=time, target=target)
    if not windows:
        return df.select("*", *lag_cols)
    if not isinstance(df.schema[target].dataType, T.IntegralType):
        return df.select("*", *lag_cols, *rolling_columns(windows, key=key, time=time, target=target))
    running = _spec(key, time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = [F.col(c) for c in df.columns]
    base = df.select(*own, *_limb_sums(target, running))
    base = base.select(*own, *lag_cols, *_earlier_sums(windows, key, time))
    lag_names = [F.col(f"lag_{k}h") for k in lags]
    return base.select(*own, *lag_names, *[c for n in windows for c in _rolling_from_limbs(n)])


def add_lags(df: DataFrame, lags=None, *, key="zone_id", time="hour",
             target="demand") -> DataFrame:
    """``lag_{k}h`` = value ``k`` records earlier in the same zone (double).

    Records equal hours only on a filled grid (``aggregate(...,
    fill_missing_hours=True)``).  ``None`` means 1 and 24.
    """
    lags = positive_ints((1, 24) if lags is None else lags, "lags")
    require_columns(df, (key, time, target), "demand panel")
    return df.select("*", *lag_columns(lags, key=key, time=time, target=target))


def add_rolling_features(df: DataFrame, windows=(24,), *, key="zone_id",
                         time="hour", target="demand") -> DataFrame:
    """``roll_mean_{w}h`` / ``roll_std_{w}h`` over the previous ``w`` records."""
    windows = positive_ints(windows, "windows")
    return add_window_features(df, (), windows, key=key, time=time, target=target)
