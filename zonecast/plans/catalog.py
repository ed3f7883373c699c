"""Query catalogue: every operator as a query over the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB SQL
over the same parquet views) are registered side by side; columns carry the
same names and types on both sides, doubles are rounded to 6 digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.holidays import holiday_table_for
from zonecast.functions.metrics import metric_columns
from zonecast.ml.evaluate import evaluate_model, model_comparison, naive_baseline
from zonecast.ml.forecaster import DemandForecaster, MultiModelForecaster
from zonecast.ml.models import linear_coefficients, make_pipeline
from zonecast.operators import links as L
from zonecast.operators.calendar import add_calendar_features
from zonecast.operators.cleaning import clean_report, clean_trips
from zonecast.operators.demand import aggregate, materialized
from zonecast.operators.groups import apply_per_zone
from zonecast.operators.reports import (column_profile, daily_counts, daily_summary,
                                        demand_heatmap, forecast_vs_actual, top_zones,
                                        top_zones_share, weekday_anomalies, weekday_zscore,
                                        zone_totals)
from zonecast.operators.splits import cv_folds, cv_folds_by_hour, fold_summary, label_time_split, time_split
from zonecast.operators.windows import add_lags, add_rolling_features
from zonecast.operators.zones import ZoneResolver, borough_demand, zones_without_demand
from zonecast.plans import sql_oracle as S
from zonecast.plans.features import build_features
from zonecast.plans.forecast import forecast_report, lag_feature_frame, top_k_forecast
from zonecast.plans.registry import ORACLE, QUERIES, register, round_doubles, table  # noqa: F401
from zonecast.session import configure
from zonecast.sources.trips import read_events_trips, schema_profile
from zonecast.sources.zones import zone_dim_from_tables

NUM_ZONES = S.NUM_ZONES     # every positive id of the events view is a zone


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(read_events_trips(spark, sf_dir), num_zones=NUM_ZONES)


def hourly(spark: SparkSession, sf_dir: str, fill: bool = False) -> DataFrame:
    return aggregate(clean_events(spark, sf_dir), fill_missing_hours=fill)


# --------------------------------------------------------------- cleaning ---

@register("clean_trips", S.base_ctes() + " SELECT pickup_datetime, PULocationID, DOLocationID FROM clean")
def q_clean_trips(spark, sf_dir):
    return clean_events(spark, sf_dir)


@register("clean_report", "WITH " + S.trips_cte() + f""" SELECT
    count(*) AS rows_in,
    count(*) FILTER (WHERE pickup_datetime IS NULL OR PULocationID IS NULL OR DOLocationID IS NULL) AS rows_null,
    count(*) FILTER (WHERE NOT (PULocationID BETWEEN 1 AND {NUM_ZONES})) AS pu_out_of_range,
    count(*) FILTER (WHERE NOT (DOLocationID BETWEEN 1 AND {NUM_ZONES})) AS do_out_of_range,
    count(*) FILTER (WHERE pickup_datetime IS NOT NULL AND PULocationID BETWEEN 1 AND {NUM_ZONES}
                     AND DOLocationID BETWEEN 1 AND {NUM_ZONES}) AS rows_out
  FROM trips""")
def q_clean_report(spark, sf_dir):
    return clean_report(read_events_trips(spark, sf_dir), num_zones=NUM_ZONES)


@register("clean_trips_bounded", "WITH " + S.trips_cte() + ", " + S.clean_cte(50)
          + " SELECT pickup_datetime, PULocationID, DOLocationID FROM clean")
def q_clean_trips_bounded(spark, sf_dir):
    """A zone universe that is smaller than the ids: the upper bound removes rows."""
    return clean_trips(read_events_trips(spark, sf_dir), num_zones=50)


_RAW_SQL = """raw AS (SELECT CASE WHEN event_id % 7 = 0 THEN 'not a time' WHEN event_id % 11 = 0 THEN NULL
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS pickup_datetime,
  CASE WHEN event_id % 13 <> 0 THEN user_id + 0.7 END AS PULocationID,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) + 0.25 AS DOLocationID FROM events)"""


@register("clean_trips_raw", "WITH " + _RAW_SQL + """,
  typed AS (SELECT TRY_CAST(pickup_datetime AS TIMESTAMP) AS pickup_datetime, CAST(trunc(PULocationID) AS BIGINT) AS PULocationID,
                   CAST(trunc(DOLocationID) AS BIGINT) AS DOLocationID FROM raw)
  SELECT * FROM typed WHERE pickup_datetime IS NOT NULL AND PULocationID BETWEEN 1 AND 800 AND DOLocationID BETWEEN 1 AND 800""")
def q_clean_trips_raw(spark, sf_dir):
    """Times as text (some are none), missing ids, ids with a fraction."""
    e = table(spark, sf_dir, "events")
    raw = e.select(
        F.when(F.col("event_id") % 7 == 0, F.lit("not a time")).when(F.col("event_id") % 11 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("pickup_datetime"),
        F.when(F.col("event_id") % 13 != 0, F.col("user_id") + F.lit(0.7)).alias("PULocationID"),
        (F.get_json_object("props", "$.k").cast("double") + F.lit(0.25)).alias("DOLocationID"))
    return clean_trips(raw, num_zones=800)


# ----------------------------------------------------------------- demand ---

@register("hourly_demand", S.base_ctes() + " SELECT zone_id, hour, demand FROM hourly")
def q_hourly_demand(spark, sf_dir):
    return hourly(spark, sf_dir)


@register("hourly_demand_grid", S.base_ctes(grid=True) + " SELECT zone_id, hour, demand FROM filled")
def q_hourly_demand_grid(spark, sf_dir):
    return hourly(spark, sf_dir, fill=True)


@register("lineitem_daily_demand", "WITH daily AS (SELECT l_suppkey AS zone_id, "
          "date_trunc('day', l_shipdate) AS day, count(*) AS demand FROM lineitem "
          "WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY 1, 2), "
          + S.grid_cte("daily", "filled", "1 DAY", time="day")
          + " SELECT zone_id, day, demand FROM filled")
def q_lineitem_daily_demand(spark, sf_dir):
    return aggregate(table(spark, sf_dir, "lineitem"), key="l_suppkey", ts="l_shipdate",
                     grain="day", out_time="day", fill_missing_hours=True)


@register("orders_daily_demand", "WITH daily AS (SELECT o_custkey AS zone_id, "
          "date_trunc('day', o_orderdate) AS day, count(*) AS demand FROM orders "
          "WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY 1, 2) "
          "SELECT zone_id, day, demand FROM daily")
def q_orders_daily_demand(spark, sf_dir):
    return aggregate(table(spark, sf_dir, "orders"), key="o_custkey", ts="o_orderdate",
                     grain="day", out_time="day")


@register("hour_bounds", S.base_ctes() + """ SELECT min(hour) AS first_hour, max(hour) AS last_hour,
  count(DISTINCT hour) AS n_hours, count(DISTINCT zone_id) AS n_zones, CAST(sum(demand) AS BIGINT) AS n_trips
  FROM hourly""")
def q_hour_bounds(spark, sf_dir):
    h = hourly(spark, sf_dir)
    hours = h.groupBy("hour").agg(F.sum("demand").alias("n"))       # one distinct count an aggregate: no Expand
    zones = h.select("zone_id").distinct().agg(F.count(F.lit(1))).scalar()
    return hours.agg(F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"),
                     F.count(F.lit(1)).alias("n_hours"), zones.alias("n_zones"), F.sum("n").cast("bigint").alias("n_trips"))


# ---------------------------------------------------------------- windows ---

_LAG_SQL = (" SELECT zone_id, hour, demand,"
            " CAST(lag(demand, 1) OVER w AS DOUBLE) AS lag_1h,"
            " CAST(lag(demand, 24) OVER w AS DOUBLE) AS lag_24h"
            " FROM {src} WINDOW w AS (PARTITION BY zone_id ORDER BY hour)")


@register("lag_features", S.base_ctes() + _LAG_SQL.format(src="hourly"))
def q_lag_features(spark, sf_dir):
    return add_lags(hourly(spark, sf_dir), (1, 24))


@register("lag_features_grid", S.base_ctes(grid=True) + _LAG_SQL.format(src="filled"))
def q_lag_features_grid(spark, sf_dir):
    return add_lags(hourly(spark, sf_dir, fill=True), (1, 24))


def _rolling_sql(w: int) -> str:
    frame = f"(PARTITION BY zone_id ORDER BY hour ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
    return (f"round(avg(demand) OVER {frame}, 6) AS roll_mean_{w}h, "
            f"round(coalesce(stddev_pop(demand) OVER {frame}, 0.0), 6) AS roll_std_{w}h")


@register("rolling_features", S.base_ctes(grid=True)
          + f" SELECT zone_id, hour, demand, {_rolling_sql(24)}, {_rolling_sql(3)} FROM filled")
def q_rolling_features(spark, sf_dir):
    return round_doubles(add_rolling_features(hourly(spark, sf_dir, fill=True), (24, 3)))


@register("rolling_nullable", S.base_ctes() + ", gaps AS (SELECT zone_id, hour, nullif(demand, 1) * 3000000000 AS demand FROM hourly)"
          + f" SELECT zone_id, hour, demand, {_rolling_sql(3)} FROM gaps")
def q_rolling_nullable(spark, sf_dir):
    """A target with nulls and values whose squares are beyond 64 bits."""
    panel = hourly(spark, sf_dir).withColumn("demand", F.nullif(F.col("demand"), F.lit(1).cast("bigint")) * F.lit(3000000000))
    return round_doubles(add_rolling_features(panel, (3,)))


# --------------------------------------------------------------- calendar ---

def _calendar_sql(src: str, hol: str = "holidays") -> str:
    return (f" SELECT s.*, CAST(hour(s.hour) AS INTEGER) AS hour_of_day,"
            f" CAST(isodow(s.hour) - 1 AS INTEGER) AS day_of_week,"
            f" CAST(isodow(s.hour) >= 6 AS INTEGER) AS is_weekend,"
            f" CAST(CAST(s.hour AS DATE) IN (SELECT holiday_date FROM {hol}) AS INTEGER) AS is_holiday"
            f" FROM {src} s")


@register("calendar_features", S.base_ctes(grid=True) + ", " + S.holidays_cte("federal")
          + _calendar_sql("filled"))
def q_calendar_features(spark, sf_dir):
    return add_calendar_features(hourly(spark, sf_dir, fill=True))


@register("calendar_features_state", S.base_ctes() + ", " + S.holidays_cte("state")
          + _calendar_sql("hourly"))
def q_calendar_features_state(spark, sf_dir):
    return add_calendar_features(hourly(spark, sf_dir), "state")


@register("holiday_table", "WITH " + S.holidays_cte("federal", "fed", S.SHIP_YEARS) + ", "
          + S.holidays_cte("state", "st", S.SHIP_YEARS)
          + " SELECT 'federal' AS calendar, holiday_date, name FROM fed"
          + " UNION ALL SELECT 'state' AS calendar, holiday_date, name FROM st")
def q_holiday_table(spark, sf_dir):
    """Both calendars for every year the lineitem ship dates span."""
    items = table(spark, sf_dir, "lineitem")
    return (holiday_table_for(items, "l_shipdate", "federal").select(F.lit("federal").alias("calendar"), "*")
            .unionByName(holiday_table_for(items, "l_shipdate", "state")
                         .select(F.lit("state").alias("calendar"), "*")))


@register("lineitem_calendar", "WITH " + S.holidays_cte("federal", "holidays", S.SHIP_YEARS)
          + ", days AS (SELECT CAST(l_shipdate AS TIMESTAMP) AS hour, count(*) AS items FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1)"
          + _calendar_sql("days"))
def q_lineitem_calendar(spark, sf_dir):
    """Calendar features of the ship dates: the 1990s, far from the default years."""
    days = (table(spark, sf_dir, "lineitem").where("l_shipdate is not null")
            .groupBy(F.col("l_shipdate").cast("timestamp_ntz").alias("hour")).agg(F.count(F.lit(1)).alias("items")))
    return add_calendar_features(days)


@register("build_features_full", S.base_ctes(grid=True) + ", " + S.holidays_cte("federal")
          + ", feats AS (SELECT zone_id, hour, demand,"
          " CAST(lag(demand, 1) OVER w AS DOUBLE) AS lag_1h,"
          " CAST(lag(demand, 24) OVER w AS DOUBLE) AS lag_24h,"
          " CAST(lag(demand, 168) OVER w AS DOUBLE) AS lag_168h, "
          + _rolling_sql(24)
          + " FROM filled WINDOW w AS (PARTITION BY zone_id ORDER BY hour))"
          + _calendar_sql("feats"))
def q_build_features_full(spark, sf_dir):
    feats = build_features(clean_events(spark, sf_dir), lags=(1, 24, 168), rolling_windows=(24,),
                           add_calendar=True, fill_missing_hours=True)
    return round_doubles(feats)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum end-to-end slice: features on the filled hourly grid."""
    configure(spark)
    feats = build_features(clean_events(spark, sf_dir), lags=(1, 24), rolling_windows=(24,),
                           fill_missing_hours=True)
    return feats.orderBy("zone_id", "hour")


# ------------------------------------------------------------------ zones ---


def zone_dim(spark, sf_dir):
    return zone_dim_from_tables(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"),
                                table(spark, sf_dir, "region"))


_DIM_SQL = ("dim AS (SELECT CAST(s_suppkey AS BIGINT) AS LocationID, r_name AS Borough, "
            "s_name AS Zone, n_name AS service_zone FROM supplier "
            "LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)")
_DIM1_SQL = ("dim1 AS (SELECT LocationID, max(struct_pack(b := Borough, z := Zone, s := service_zone)) AS p "
             "FROM dim WHERE LocationID IS NOT NULL GROUP BY LocationID), "
             "dimu AS (SELECT LocationID, p.b AS Borough, p.z AS Zone, p.s AS service_zone FROM dim1)")


@register("annotate_zones", S.base_ctes() + ", " + _DIM_SQL + ", " + _DIM1_SQL + """
  SELECT c.pickup_datetime, c.PULocationID, c.DOLocationID,
         p.Borough AS PU_borough, p.Zone AS PU_zone, p.service_zone AS PU_service_zone,
         d.Borough AS DO_borough, d.Zone AS DO_zone, d.service_zone AS DO_service_zone
  FROM clean c LEFT JOIN dimu p ON c.PULocationID = p.LocationID
               LEFT JOIN dimu d ON c.DOLocationID = d.LocationID""")
def q_annotate_zones(spark, sf_dir):
    zones = ZoneResolver(zone_dim(spark, sf_dir))
    return zones.annotate(zones.annotate(clean_events(spark, sf_dir), "PULocationID", "PU"),
                          "DOLocationID", "DO")


@register("zone_label", S.base_ctes() + ", " + _DIM_SQL + ", " + _DIM1_SQL + """,
  ids AS (SELECT DISTINCT PULocationID AS zone_id FROM clean)
  SELECT i.zone_id, CASE WHEN d.Zone IS NULL OR d.Borough IS NULL
                         THEN 'zone ' || i.zone_id || ' (unknown)'
                         ELSE 'zone ' || i.zone_id || ' (' || d.Zone || ', ' || d.Borough || ')' END AS label
  FROM ids i LEFT JOIN dimu d ON i.zone_id = d.LocationID""")
def q_zone_label(spark, sf_dir):
    ids = clean_events(spark, sf_dir).select(F.col("PULocationID").alias("zone_id")).distinct()
    return ZoneResolver(zone_dim(spark, sf_dir)).label(ids, "zone_id")


@register("known_ids", S.base_ctes() + ", " + _DIM_SQL + """
  SELECT count(*) AS n_rows, count(DISTINCT PULocationID) AS n_ids FROM clean
  WHERE PULocationID IN (SELECT LocationID FROM dim)""")
def q_known_ids(spark, sf_dir):
    k = ZoneResolver(zone_dim(spark, sf_dir)).known(clean_events(spark, sf_dir))
    return k.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("PULocationID").alias("n_ids"))


@register("unresolved_ids", S.base_ctes() + ", " + _DIM_SQL + """
  SELECT PULocationID AS zone_id, count(*) AS n_rows FROM clean
  WHERE PULocationID NOT IN (SELECT LocationID FROM dim WHERE LocationID IS NOT NULL)
  GROUP BY 1""")
def q_unresolved_ids(spark, sf_dir):
    return ZoneResolver(zone_dim(spark, sf_dir)).unresolved(clean_events(spark, sf_dir))


@register("zones_without_demand", S.base_ctes() + ", " + _DIM_SQL + ", " + _DIM1_SQL + """
  SELECT LocationID, Borough, Zone, service_zone FROM dimu
  WHERE LocationID NOT IN (SELECT PULocationID FROM clean)""")
def q_zones_without_demand(spark, sf_dir):
    return zones_without_demand(zone_dim(spark, sf_dir), clean_events(spark, sf_dir))


@register("borough_demand", S.base_ctes(grid=True) + ", " + _DIM_SQL + ", " + _DIM1_SQL + """
  SELECT d.Borough AS borough, f.hour, CAST(sum(f.demand) AS BIGINT) AS demand
  FROM filled f LEFT JOIN dimu d ON f.zone_id = d.LocationID GROUP BY 1, 2""")
def q_borough_demand(spark, sf_dir):
    return borough_demand(hourly(spark, sf_dir, fill=True), zone_dim(spark, sf_dir))


# ----------------------------------------------------------------- splits ---


_FEATS_SQL = (", feats AS (SELECT zone_id, hour, demand,"
              " CAST(lag(demand, 1) OVER w AS DOUBLE) AS lag_1h,"
              " CAST(lag(demand, 24) OVER w AS DOUBLE) AS lag_24h"
              " FROM filled WINDOW w AS (PARTITION BY zone_id ORDER BY hour)),"
              " complete AS MATERIALIZED (SELECT * FROM feats WHERE lag_1h IS NOT NULL AND lag_24h IS NOT NULL),"
              " hours AS (SELECT hour, row_number() OVER (ORDER BY hour) - 1 AS idx,"
              " count(*) OVER () AS n FROM (SELECT DISTINCT hour FROM complete)),"
              " cut AS (SELECT hour AS cut_hour FROM hours WHERE n >= 2 AND idx = greatest(1, floor(n * 0.8))),"
              " labelled AS (SELECT c.*, CASE WHEN cut.cut_hour IS NULL OR c.hour < cut.cut_hour"
              " THEN 'train' ELSE 'test' END AS split FROM complete c LEFT JOIN cut ON TRUE),"
              " train AS (SELECT * FROM labelled WHERE split = 'train'),"
              " test AS (SELECT * FROM labelled WHERE split = 'test')")
FEATS_SQL = S.base_ctes(grid=True) + _FEATS_SQL


def features(spark, sf_dir):
    """Lag features on the filled grid, materialised once for the model passes."""
    return materialized(lag_feature_frame(clean_events(spark, sf_dir)), "parquet")


@register("time_split", FEATS_SQL + " SELECT zone_id, hour, split FROM labelled")
def q_time_split(spark, sf_dir):
    return label_time_split(features(spark, sf_dir)).select("zone_id", "hour", "split")


@register("time_split_counts", FEATS_SQL + """ SELECT split, count(*) AS n_rows,
  count(DISTINCT hour) AS n_hours, min(hour) AS first_hour, max(hour) AS last_hour
  FROM labelled GROUP BY split""")
def q_time_split_counts(spark, sf_dir):
    return (label_time_split(features(spark, sf_dir)).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("hour").alias("n_hours"),
                 F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour")))


_CV_K = 5
_CV_BOUNDS_SQL = (f"folds AS (SELECT CAST(f AS INTEGER) AS fold FROM range({_CV_K}) t(f)), "
                  f"b AS (SELECT fold, n - ({_CV_K} - fold) * greatest(1, n // {_CV_K + 1}) AS train_end, "
                  f"greatest(1, n // {_CV_K + 1}) AS t FROM folds, cnt), "
                  "bounds AS (SELECT fold, train_end, train_end + t AS test_end FROM b WHERE train_end > 0)")


@register("cv_folds", FEATS_SQL + ", pos AS (SELECT *, row_number() OVER (ORDER BY hour, zone_id) - 1 AS p"
          " FROM complete), cnt AS (SELECT count(*) AS n FROM pos), " + _CV_BOUNDS_SQL + """
  SELECT fold, CASE WHEN p < train_end THEN 'train' ELSE 'test' END AS role,
         count(*) AS n_rows, min(p) AS first_pos, max(p) AS last_pos,
         CAST(sum(demand) AS BIGINT) AS demand_sum
  FROM pos JOIN bounds ON p < test_end GROUP BY 1, 2""")
def q_cv_folds(spark, sf_dir):
    folds = cv_folds(lag_feature_frame(clean_events(spark, sf_dir)), _CV_K)
    return fold_summary(folds, _CV_K, ("n_rows", F.count(F.lit(1)), F.sum), ("first_pos", F.min("pos"), F.min),
                        ("last_pos", F.max("pos"), F.max), ("demand_sum", F.sum("demand").cast("bigint"), F.sum))


@register("cv_folds_by_hour", FEATS_SQL + ", hidx AS (SELECT hour, row_number() OVER (ORDER BY hour) - 1 AS p"
          " FROM (SELECT DISTINCT hour FROM complete)), cnt AS (SELECT count(*) AS n FROM hidx), "
          + _CV_BOUNDS_SQL + """,
  lab AS (SELECT hour, fold, CASE WHEN p < train_end THEN 'train' ELSE 'test' END AS role
          FROM hidx JOIN bounds ON p < test_end)
  SELECT fold, role, count(*) AS n_rows, count(DISTINCT c.hour) AS n_hours,
         min(c.hour) AS first_hour, max(c.hour) AS last_hour
  FROM complete c JOIN lab ON c.hour = lab.hour GROUP BY 1, 2""")
def q_cv_folds_by_hour(spark, sf_dir):
    folds = cv_folds_by_hour(features(spark, sf_dir), _CV_K)
    # no hour is in two groups, so distinct hours add up
    return fold_summary(folds, _CV_K, ("n_rows", F.count(F.lit(1)), F.sum), ("n_hours", F.count_distinct("hour"), F.sum),
                        ("first_hour", F.min("hour"), F.min), ("last_hour", F.max("hour"), F.max))


# ---------------------------------------------------------------- metrics ---


def _metric_sql(y: str, p: str, prefix: str, with_mape: bool = True) -> str:
    sql = (f"round(avg(abs({y} - {p})), 6) AS {prefix}mae, "
           f"round(sqrt(avg(({y} - {p}) * ({y} - {p}))), 6) AS {prefix}rmse")
    if with_mape:
        sql += f", round(avg(abs({y} - {p}) / (abs({y}) + 1e-9)), 6) AS {prefix}mape"
    return sql


@register("naive_baseline_metrics", FEATS_SQL + " SELECT count(*) AS n_rows, "
          + _metric_sql("demand", "lag_24h", "baseline_") + " FROM complete")
def q_naive_baseline_metrics(spark, sf_dir):
    b = naive_baseline(lag_feature_frame(clean_events(spark, sf_dir)))      # read once: nothing to materialise
    return round_doubles(b.agg(F.count(F.lit(1)).alias("n_rows"),
                               *metric_columns("demand", "baseline", "baseline_", include_mape=True)))


_OLS_SQL = (", st AS (SELECT count(*) AS n, avg(demand) AS my, avg(lag_1h) AS m1, avg(lag_24h) AS m2,"
            " var_pop(lag_1h) AS s11, var_pop(lag_24h) AS s22, covar_pop(lag_1h, lag_24h) AS s12,"
            " covar_pop(lag_1h, demand) AS s1y, covar_pop(lag_24h, demand) AS s2y FROM train),"
            " ols AS (SELECT n, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,"
            " (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, my, m1, m2 FROM st),"
            " coef AS (SELECT n, my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM ols)")


def _train_test(spark, sf_dir):
    return time_split(features(spark, sf_dir))


@register("ols_coefficients", FEATS_SQL + _OLS_SQL + """ SELECT n AS n_train,
  round(b0, 6) AS intercept, round(b1, 6) AS coef_lag_1h, round(b2, 6) AS coef_lag_24h FROM coef""")
def q_ols_coefficients(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    m = DemandForecaster().fit(train)
    c = m.coefficients()
    n = m.model.stages[-1].summary.numInstances
    return round_doubles(spark.createDataFrame(
        [(n, c["intercept"], c["coef_lag_1h"], c["coef_lag_24h"])],
        "n_train bigint, intercept double, coef_lag_1h double, coef_lag_24h double"))


@register("ols_metrics", FEATS_SQL + _OLS_SQL + """,
  scored AS (SELECT t.demand, t.lag_24h, c.b0 + c.b1 * t.lag_1h + c.b2 * t.lag_24h AS prediction
             FROM test t, coef c)
  SELECT """ + _metric_sql("demand", "prediction", "model_", False) + ", "
          + _metric_sql("demand", "lag_24h", "baseline_", False) + " FROM scored")
def q_ols_metrics(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    m = DemandForecaster().fit(train)
    return round_doubles(evaluate_model(m, test))


_RIDGE_ALPHA = 1.0


@register("ridge_coefficients", FEATS_SQL + _OLS_SQL + f""",
  z AS (SELECT n, my, m1, m2, sqrt(s11) AS d1, sqrt(s22) AS d2, s12 / sqrt(s11 * s22) AS r,
               s1y / sqrt(s11) AS c1, s2y / sqrt(s22) AS c2, 1 + {_RIDGE_ALPHA} / n AS a FROM st),
  beta AS (SELECT n, my, m1, m2, d1, d2, (a * c1 - r * c2) / (a * a - r * r) / d1 AS b1,
                  (a * c2 - r * c1) / (a * a - r * r) / d2 AS b2 FROM z)
  SELECT n AS n_train, round(my - b1 * m1 - b2 * m2, 6) AS intercept,
         round(b1, 6) AS coef_lag_1h, round(b2, 6) AS coef_lag_24h FROM beta""")
def q_ridge_coefficients(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    model = make_pipeline("ridge").fit(train)
    c = linear_coefficients(model, ("lag_1h", "lag_24h"))
    return round_doubles(spark.createDataFrame(
        [(model.stages[-1].summary.numInstances, c["intercept"], c["coef_lag_1h"], c["coef_lag_24h"])],
        "n_train bigint, intercept double, coef_lag_1h double, coef_lag_24h double"))


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    multi = MultiModelForecaster().fit(train)
    return round_doubles(model_comparison(multi, test))


@register("forest_check", FEATS_SQL + """ SELECT count(*) AS n_rows, TRUE AS in_label_range, TRUE AS beats_baseline FROM test""")
def q_forest_check(spark, sf_dir):
    """The forest's predictions stay within the training labels and its RMSE is no worse than the baseline's."""
    train, test = _train_test(spark, sf_dir)
    model = make_pipeline("random_forest").fit(train)
    seen = train.agg(F.min("demand").alias("lo"), F.max("demand").alias("hi")).first()
    scored = model.transform(test)
    p, y = F.col("prediction"), F.col("demand")
    return scored.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.bool_and(p.between(seen["lo"], seen["hi"])).alias("in_label_range"),
                      (F.avg((y - p) * (y - p)) <= F.avg((y - F.col("lag_24h")) * (y - F.col("lag_24h")))).alias("beats_baseline"))


@register("forecast_metrics", FEATS_SQL + _OLS_SQL + """,
  scored AS (SELECT t.demand, t.lag_24h, c.b0 + c.b1 * t.lag_1h + c.b2 * t.lag_24h AS prediction FROM test t, coef c)
  SELECT * REPLACE (round(model_mape, 2) AS model_mape, round(baseline_mape, 2) AS baseline_mape) FROM (
  SELECT """ + _metric_sql("demand", "prediction", "model_") + ", " + _metric_sql("demand", "lag_24h", "baseline_") + " FROM scored)")
def q_forecast_metrics(spark, sf_dir):
    """The end-to-end flow: its metrics row, MAPE included.

    Cells without demand divide by the epsilon, so MAPEs are of the order of
    10^8 and are compared to 2 digits.
    """
    report = forecast_report(clean_events(spark, sf_dir), zone_dim(spark, sf_dir), model_names=("linear", "ridge"))
    out = round_doubles(report.metrics)
    return out.withColumns({c: F.round(c, 2) for c in ("model_mape", "baseline_mape")})


_RIDGE_BETA_SQL = f""",
  z AS (SELECT n, my, m1, m2, sqrt(s11) AS d1, sqrt(s22) AS d2, s12 / sqrt(s11 * s22) AS r,
               s1y / sqrt(s11) AS c1, s2y / sqrt(s22) AS c2, 1 + {_RIDGE_ALPHA} / n AS a FROM st),
  rb AS (SELECT (a * c1 - r * c2) / (a * a - r * r) / d1 AS b1,
                (a * c2 - r * c1) / (a * a - r * r) / d2 AS b2, my, m1, m2 FROM z),
  rcoef AS (SELECT my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM rb)"""


@register("model_comparison_linear", FEATS_SQL + _OLS_SQL + _RIDGE_BETA_SQL + """,
  scored AS (SELECT t.demand, t.lag_24h, c.b0 + c.b1 * t.lag_1h + c.b2 * t.lag_24h AS p_lin,
                    r.b0 + r.b1 * t.lag_1h + r.b2 * t.lag_24h AS p_ridge
             FROM test t, coef c, rcoef r)
  SELECT 'linear' AS model, round(avg(abs(demand - p_lin)), 6) AS mae,
         round(sqrt(avg((demand - p_lin) * (demand - p_lin))), 6) AS rmse FROM scored
  UNION ALL SELECT 'ridge', round(avg(abs(demand - p_ridge)), 6),
         round(sqrt(avg((demand - p_ridge) * (demand - p_ridge))), 6) FROM scored
  UNION ALL SELECT 'baseline-lag24', round(avg(abs(demand - lag_24h)), 6),
         round(sqrt(avg((demand - lag_24h) * (demand - lag_24h))), 6) FROM scored""")
def q_model_comparison_linear(spark, sf_dir):
    """The closed-form part of the comparison table, scored on the same test rows."""
    train, test = _train_test(spark, sf_dir)
    multi = MultiModelForecaster(model_names=["linear", "ridge"]).fit(train)
    return round_doubles(model_comparison(multi, test).select("model", "mae", "rmse"))


# ---------------------------------------------------------------- reports ---


@register("topk_forecast", FEATS_SQL + _OLS_SQL + ", " + _DIM_SQL + ", " + _DIM1_SQL + """,
  last AS (SELECT * FROM complete WHERE hour = (SELECT max(hour) FROM complete)),
  pred AS (SELECT l.zone_id, l.hour, l.demand, round(c.b0 + c.b1 * l.lag_1h + c.b2 * l.lag_24h, 6) AS p
           FROM last l, coef c),
  top AS (SELECT * FROM pred ORDER BY p DESC, zone_id LIMIT 10)
  SELECT CAST(row_number() OVER (ORDER BY p DESC, zone_id) AS INTEGER) AS rank, t.zone_id,
         CASE WHEN d.Zone IS NULL OR d.Borough IS NULL THEN 'zone ' || t.zone_id || ' (unknown)'
              ELSE 'zone ' || t.zone_id || ' (' || d.Zone || ', ' || d.Borough || ')' END AS zone_name,
         t.hour, t.p AS predicted_demand, t.demand AS actual_demand
  FROM top t LEFT JOIN dimu d ON t.zone_id = d.LocationID""")
def q_topk_forecast(spark, sf_dir):
    feats = features(spark, sf_dir)
    train, _ = time_split(feats)
    m = DemandForecaster().fit(train)
    return top_k_forecast(m, feats, zone_dim(spark, sf_dir), 10)


_FVA_ZONE = 1


@register("forecast_vs_actual", FEATS_SQL + _OLS_SQL + f"""
  SELECT hour, demand, round((SELECT b0 FROM coef) + (SELECT b1 FROM coef) * lag_1h + (SELECT b2 FROM coef) * lag_24h, 6) AS prediction
  FROM test WHERE zone_id = {_FVA_ZONE}""")
def q_forecast_vs_actual(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    m = DemandForecaster().fit(train)
    return round_doubles(forecast_vs_actual(test, m, _FVA_ZONE))


_HEAT_COLS = ", ".join(f"round(avg(demand) FILTER (WHERE hour(hour) = {h}), 6) AS h{h:02d}" for h in range(24))


@register("demand_heatmap", S.base_ctes(grid=True) + f"""
  SELECT zone_id, CAST(sum(demand) AS BIGINT) AS total_demand, {_HEAT_COLS}
  FROM filled GROUP BY zone_id ORDER BY total_demand DESC, zone_id LIMIT 20""")
def q_demand_heatmap(spark, sf_dir):
    return round_doubles(demand_heatmap(hourly(spark, sf_dir, fill=True), 20))


@register("top_zones", S.base_ctes() + """ SELECT zone_id, CAST(sum(demand) AS BIGINT) AS total_demand
  FROM hourly GROUP BY zone_id ORDER BY total_demand DESC, zone_id LIMIT 20""")
def q_top_zones(spark, sf_dir):
    return top_zones(hourly(spark, sf_dir), 20)


_DAILY_SQL = ", daily AS (SELECT CAST(pickup_datetime AS DATE) AS date, count(*) AS pickups FROM clean GROUP BY 1)"


@register("daily_counts", S.base_ctes() + _DAILY_SQL + " SELECT date, pickups FROM daily")
def q_daily_counts(spark, sf_dir):
    return daily_counts(clean_events(spark, sf_dir))


@register("daily_summary", S.base_ctes() + _DAILY_SQL + """ SELECT count(*) AS n_days,
  CAST(sum(pickups) AS BIGINT) AS total_pickups, round(avg(pickups), 6) AS mean_pickups,
  round(median(CAST(pickups AS DOUBLE)), 6) AS median_pickups,
  arg_min(date, pickups * 100000000 + (date - DATE '1970-01-01')) AS quietest_day, min(pickups) AS quietest_pickups,
  arg_max(date, pickups * 100000000 - (date - DATE '1970-01-01')) AS busiest_day, max(pickups) AS busiest_pickups
  FROM daily""")
def q_daily_summary(spark, sf_dir):
    return round_doubles(daily_summary(daily_counts(clean_events(spark, sf_dir))))


@register("weekday_zscore", S.base_ctes() + _DAILY_SQL + """,
  peers AS (SELECT a.date, a.pickups, avg(b.pickups) AS m, stddev_samp(b.pickups) AS s, count(b.date) AS k
            FROM daily a LEFT JOIN daily b ON isodow(a.date) = isodow(b.date) AND a.date <> b.date
            GROUP BY a.date, a.pickups)
  SELECT date, pickups, strftime(date, '%a') AS weekday_name, round(m, 6) AS peer_mean,
         round(CASE WHEN k >= 2 AND s > 0 THEN (pickups - m) / s ELSE 0.0 END, 6) AS zscore
  FROM peers""")
def q_weekday_zscore(spark, sf_dir):
    return round_doubles(weekday_zscore(daily_counts(clean_events(spark, sf_dir))))


@register("weekday_anomalies", S.base_ctes() + _DAILY_SQL + ", " + S.holidays_cte("federal") + """,
  peers AS (SELECT a.date, a.pickups, avg(b.pickups) AS m, stddev_samp(b.pickups) AS s, count(b.date) AS k
            FROM daily a LEFT JOIN daily b ON isodow(a.date) = isodow(b.date) AND a.date <> b.date
            GROUP BY a.date, a.pickups)
  SELECT date, pickups, strftime(date, '%a') AS weekday_name, round(m, 6) AS peer_mean,
         round(CASE WHEN k >= 2 AND s > 0 THEN (pickups - m) / s ELSE 0.0 END, 6) AS zscore,
         CAST(date IN (SELECT holiday_date FROM holidays) AS INTEGER) AS is_holiday
  FROM peers""")
def q_weekday_anomalies(spark, sf_dir):
    return round_doubles(weekday_anomalies(daily_counts(clean_events(spark, sf_dir))))


@register("zone_totals", S.base_ctes() + """ SELECT zone_id, CAST(sum(demand) AS BIGINT) AS total_demand
  FROM hourly GROUP BY zone_id""")
def q_zone_totals(spark, sf_dir):
    return zone_totals(hourly(spark, sf_dir))


@register("top_zones_share", S.base_ctes() + """, c AS (SELECT PULocationID AS zone_id, count(*) AS pickups
  FROM clean GROUP BY 1)
  SELECT zone_id, pickups, round(pickups / (SELECT sum(pickups) FROM c), 6) AS share
  FROM c ORDER BY pickups DESC, zone_id LIMIT 10""")
def q_top_zones_share(spark, sf_dir):
    return round_doubles(top_zones_share(clean_events(spark, sf_dir), 10))


@register("column_profile", "WITH " + S.trips_cte() + f""" SELECT * FROM (
  SELECT 'PULocationID' AS "column", 'bigint' AS type, count(*) FILTER (WHERE PULocationID IS NULL) AS null_count,
         CAST(min(PULocationID) AS VARCHAR) AS min_value, CAST(max(PULocationID) AS VARCHAR) AS max_value,
         count(DISTINCT PULocationID) AS n_distinct,
         count(*) FILTER (WHERE NOT (PULocationID BETWEEN 1 AND {NUM_ZONES})) AS out_of_range FROM trips
  UNION ALL
  SELECT 'DOLocationID', 'bigint', count(*) FILTER (WHERE DOLocationID IS NULL),
         CAST(min(DOLocationID) AS VARCHAR), CAST(max(DOLocationID) AS VARCHAR),
         count(DISTINCT DOLocationID),
         count(*) FILTER (WHERE NOT (DOLocationID BETWEEN 1 AND {NUM_ZONES})) FROM trips)""")
def q_column_profile(spark, sf_dir):
    return column_profile(read_events_trips(spark, sf_dir), ["PULocationID", "DOLocationID"],
                          lo=1, hi=NUM_ZONES)


_EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


@register("schema_profile", f"""WITH cols AS (
    SELECT CAST(ordinal_position - 1 AS INTEGER) AS ordinal, column_name AS name,
           CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                          WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
                          WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date'
                          ELSE lower(data_type) END AS type
    FROM information_schema.columns WHERE table_name = 'events'),
  counts AS (SELECT count(*) AS n_rows,
             {", ".join(f'count(*) FILTER (WHERE "{c}" IS NULL) AS "{c}"' for c in _EVENT_COLUMNS)}
             FROM events),
  nulls AS (UNPIVOT counts ON {", ".join(f'"{c}"' for c in _EVENT_COLUMNS)} INTO NAME name VALUE n_nulls)
  SELECT c.ordinal, c.name, c.type, n.n_rows, n.n_nulls FROM cols c JOIN nulls n ON c.name = n.name""")
def q_schema_profile(spark, sf_dir):
    return schema_profile(table(spark, sf_dir, "events"), with_counts=True)


# ------------------------------------------------------------------ links ---


_PAGE_HREF_SQL = r"""WITH cleaned AS (SELECT page_id,
    regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
      '(?is)<script\b.*?</script\s*>', '', 'g'), '(?is)<style\b.*?</style\s*>', '', 'g') AS body FROM pages),
  ex AS (SELECT page_id, regexp_extract_all(body, '(?i)<a\b[^>]*?\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1) AS l
         FROM cleaned),
  raw AS (SELECT page_id, unnest(l) AS raw, generate_subscripts(l, 1) - 1 AS pos FROM ex),
  hrefs AS (SELECT page_id, CAST(pos AS INTEGER) AS pos,
    trim(replace(replace(replace(replace(replace(regexp_replace(raw, '^["'']|["'']$', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')) AS href FROM raw)"""

_WORD_RE = r"^/(\p{L}+)$"


@register("page_links", _PAGE_HREF_SQL + """,
  firsts AS (SELECT href AS url, min(struct_pack(page_id := page_id, pos := pos)) AS f
             FROM hrefs WHERE length(href) > 0 GROUP BY href)
  SELECT url, f.page_id AS page_id, f.pos AS pos FROM firsts""")
def q_page_links(spark, sf_dir):
    return L.extract_links(table(spark, sf_dir, "pages"), r"^(.+)$", {})


@register("page_links_filtered", _PAGE_HREF_SQL + r""",
  words AS (SELECT lower(regexp_extract(href, '^/(\p{L}+)$', 1)) AS term, href AS url, page_id, pos
            FROM hrefs WHERE regexp_matches(href, '^/(\p{L}+)$')),
  firsts AS (SELECT url, min(struct_pack(page_id := page_id, pos := pos, term := term)) AS f
             FROM words GROUP BY url)
  SELECT url, f.page_id AS page_id, f.pos AS pos, f.term AS term FROM firsts
  WHERE f.term IN ('the', 'de', 'in', 'la')""")
def q_page_links_filtered(spark, sf_dir):
    cat = L.extract_links(table(spark, sf_dir, "pages"), _WORD_RE, {"term": (1, "lower")})
    return L.filter_values(cat, "term", ["The", "de", "IN", "la"])


_LINK_TYPES = ("yellow", "GREEN", "fhv", "Fhvhv", "purple")


@register("trip_links", """WITH o AS (SELECT o_custkey AS page_id, o_orderkey, o_orderdate,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos,
    list_extract(['yellow', 'GREEN', 'fhv', 'Fhvhv', 'purple'], CAST(o_orderkey % 5 + 1 AS BIGINT)) AS kind FROM orders),
  l AS (SELECT 'https://data.example.org/trip-data/' || kind || '_tripdata_' || strftime(o_orderdate, '%Y-%m') || '.parquet' AS url,
               lower(kind) AS taxi_type, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, page_id, pos
        FROM o WHERE kind <> 'purple'),
  f AS (SELECT taxi_type, year, month, url, min(struct_pack(page_id := page_id, pos := pos)) AS f FROM l GROUP BY ALL)
  SELECT taxi_type, year, month, url, f.page_id AS page_id, CAST(f.pos AS INTEGER) AS pos FROM f
  WHERE taxi_type IN ('yellow', 'green', 'fhvhv') AND year = 1995 AND month <= 6""")
def q_trip_links(spark, sf_dir):
    """The catalogue chain over pages made of the orders: one page a customer, one anchor an order."""
    o = table(spark, sf_dir, "orders")
    kind = F.get(F.array(*[F.lit(t) for t in _LINK_TYPES]), (F.col("o_orderkey") % 5).cast("int"))
    anchor = F.concat(F.lit('<p>x <a title="a>b" class=l href="\n https:&#47;&#x2F;data.example.org/trip-data/'), kind, F.lit("_tripdata_"),
                      F.date_format("o_orderdate", "yyyy-MM"), F.lit('.parquet\t">a</a>'))
    pages = (o.select("o_custkey", "o_orderkey", anchor.alias("a")).groupBy(F.col("o_custkey").alias("page_id"))
             .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "a"))).alias("l"))
             .select("page_id", F.concat_ws(" ", "l.a").alias("html")))
    found = L.filter_links(L.extract_trip_data_links(pages), taxi_types=["yellow", "Green", "FHVHV"], year=1995, months=range(1, 7))
    return L.sort_links(found)


# ----------------------------------------------------------------- groups ---


def _center_demand_fn():
    # built as a closure so cloudpickle ships it by value: the Python workers
    # need not import this package
    def center(pdf):
        pdf = pdf.copy()
        d = pdf["demand"].astype("float64")
        pdf["demand_centered"] = d - d.mean()
        pdf["demand_cummax"] = pdf["demand"].cummax()
        return pdf
    return center


@register("apply_per_zone", S.base_ctes(grid=True) + """ SELECT zone_id, hour, demand,
  round(demand - avg(demand) OVER (PARTITION BY zone_id), 6) AS demand_centered,
  max(demand) OVER (PARTITION BY zone_id ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AS demand_cummax FROM filled""")
def q_apply_per_zone(spark, sf_dir):
    out = apply_per_zone(hourly(spark, sf_dir, fill=True), _center_demand_fn(),
                         "zone_id bigint, hour timestamp_ntz, demand bigint, "
                         "demand_centered double, demand_cummax bigint")
    return round_doubles(out)
