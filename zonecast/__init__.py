"""zonecast — hourly demand analytics as lazy Spark DataFrame transforms.

Every public operator is a ``DataFrame -> DataFrame`` function (or a Spark ML
estimator wrapper).  Nothing runs until the caller triggers an action, except
where a frame is read by several branches and is checkpointed once (noted in
each docstring), so a chain of operators is one Catalyst plan: filters reach
the parquet scan, columns are pruned, window stages share their exchange.
"""

from zonecast.session import checkpoint_dir, configure, get_session
from zonecast.sources.trips import (NUM_TAXI_ZONES, REQUIRED_COLUMNS, footer_stats, load, month_path,
                                    read_months, read_raw, schema_profile)
from zonecast.sources.month_store import read_month_range, read_month_store, stored_months, write_months
from zonecast.sources.sinks import read_positions, write_bucketed, write_sorted
from zonecast.sources.zones import EXPECTED_COLUMNS, load_zone_lookup, read_zone_lookup
from zonecast.functions.guards import guard_report
from zonecast.operators.cleaning import clean_report, clean_trips
from zonecast.operators.demand import aggregate, fill_grid, grid, hour_bounds
from zonecast.operators.windows import add_lags, add_rolling_features, add_window_features
from zonecast.operators.calendar import add_calendar_features
from zonecast.functions.holidays import holiday_dates, holiday_table, holiday_table_for, is_holiday
from zonecast.functions.metrics import mae, mape, regression_metrics, rmse
from zonecast.operators.zones import ZoneResolver, borough_demand, zones_without_demand
from zonecast.operators.splits import (cv_folds, cv_folds_by_hour, fold_rows, fold_summary, label_time_split,
                                       time_series_cv_split, time_split, with_positions)
from zonecast.operators.links import (SUPPORTED_TAXI_TYPES, TRIP_LINK_SCHEMA, extract_links,
                                      extract_trip_data_links, filter_links, sort_links)
from zonecast.operators.groups import apply_per_zone
from zonecast.operators.reports import (column_profile, daily_counts, daily_summary,
                                        demand_heatmap, forecast_vs_actual, top_zones,
                                        top_zones_share, weekday_anomalies, weekday_zscore,
                                        zone_totals)
from zonecast.ml.models import (DEFAULT_FEATURE_COLUMNS, DEFAULT_RANDOM_STATE, SUPPORTED_MODELS,
                                make_pipeline, train_models)
from zonecast.ml.forecaster import DemandForecaster, MultiModelForecaster, saved_versions
from zonecast.ml.columns import ColumnModel, LinearColumns
from zonecast.ml.forest_nodes import NodeForest, check_nodes, node_table, score_by_nodes
from zonecast.ml.evaluate import evaluate_model, model_comparison, naive_baseline
from zonecast.plans.features import build_features
from zonecast.plans.forecast import forecast_report, top_k_forecast
from zonecast.streaming.hourly import hourly_demand_stream, start_hourly_demand

__version__ = "0.1.0"
