"""Feature building: hourly aggregate → lags → rolling stats → calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame

from zonecast.functions.columns import positive_ints
from zonecast.operators.calendar import add_calendar_features
from zonecast.operators.demand import aggregate
from zonecast.operators.windows import add_window_features

DEFAULT_LAGS = (1, 24)


def build_features(trips: DataFrame, lags=None, rolling_windows=None,
                   add_calendar: bool = False, holidays=None, *,
                   fill_missing_hours: bool = False,
                   key: str = "PULocationID", ts: str = "pickup_datetime") -> DataFrame:
    """One lazy plan from trips to the feature frame.

    Defaults give exactly ``zone_id, hour, demand, lag_1h, lag_24h``.
    ``rolling_windows=None`` skips rolling features; an empty list is an
    error.  Lags and rolling columns share one window exchange and sort.
    """
    lags = positive_ints(DEFAULT_LAGS if lags is None else lags, "lags")
    windows = None if rolling_windows is None else positive_ints(rolling_windows, "rolling_windows")
    panel = aggregate(trips, fill_missing_hours=fill_missing_hours, key=key, ts=ts)
    feats = add_window_features(panel, lags, windows or ())
    if add_calendar:
        feats = add_calendar_features(feats, holidays)
    return feats
