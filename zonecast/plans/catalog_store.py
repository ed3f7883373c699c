"""Queries of the sources, sinks and stored models: what is written, and read back from storage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from zonecast.functions.guards import guard_report
from zonecast.ml.columns import LinearColumns
from zonecast.ml.evaluate import evaluate_model
from zonecast.ml.forecaster import DemandForecaster
from zonecast.ml.forest_nodes import NodeForest, check_nodes
from zonecast.ml.models import make_pipeline
from zonecast.operators import links as L
from zonecast.operators.cleaning import clean_trips
from zonecast.operators.demand import aggregate, materialized
from zonecast.operators.splits import with_positions
from zonecast.operators.zones import ZoneResolver
from zonecast.plans import catalog as C
from zonecast.plans import sql_oracle as S
from zonecast.plans.registry import register, round_doubles, table
from zonecast.session import shared_path
from zonecast.sources.month_store import months_between, read_month_store, stored_months, write_months
from zonecast.sources.sinks import read_positions, write_bucketed, write_sorted
from zonecast.sources.trips import footer_stats, read_events_trips, read_months
from zonecast.sources.zones import read_zone_lookup

# ----------------------------------------------------------------- months ---


def _order_trips(spark, sf_dir):
    """The orders as trips: years of them, from one customer to an order key."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("pickup_datetime"), F.col("o_custkey").alias("PULocationID"),
                                                 F.col("o_orderkey").alias("DOLocationID"))


@register("month_store", """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  count(*) AS n_trips, count(DISTINCT o_custkey) AS n_zones, min(o_orderdate) AS first_trip, max(o_orderdate) AS last_trip
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2""")
def q_month_store(spark, sf_dir):
    """The whole table written by month and every stored month read back."""
    base = shared_path(spark, "month-store")
    write_months(_order_trips(spark, sf_dir), base, rows_per_file=100_000)
    months = [(r["year"], r["month"]) for r in stored_months(spark, base).collect()]      # one row a month
    trips = read_month_store(spark, base, months, first=None)
    return trips.groupBy(F.year("pickup_datetime").alias("year"), F.month("pickup_datetime").alias("month")).agg(
        F.count(F.lit(1)).alias("n_trips"), F.count_distinct("PULocationID").alias("n_zones"),
        F.min("pickup_datetime").alias("first_trip"), F.max("pickup_datetime").alias("last_trip"))


_RANGE = (dt.datetime(1995, 12, 16), dt.datetime(1996, 3, 10))


@register("month_range_demand", f"""SELECT o_custkey AS zone_id, date_trunc('day', o_orderdate) AS day, count(*) AS demand FROM orders
  WHERE o_orderdate >= TIMESTAMP '{_RANGE[0]}' AND o_orderdate < TIMESTAMP '{_RANGE[1]}' AND o_custkey BETWEEN 1 AND {S.NUM_ZONES}
    AND o_orderkey BETWEEN 1 AND {S.NUM_ZONES} GROUP BY 1, 2""")
def q_month_range_demand(spark, sf_dir):
    """A range over the turn of a year: its four months are listed, the time bounds are pushed down."""
    base = shared_path(spark, "month-range")
    write_months(_order_trips(spark, sf_dir), base)
    trips = read_month_store(spark, base, months_between(*_RANGE), start=_RANGE[0], end=_RANGE[1], first=None)
    return aggregate(clean_trips(trips, num_zones=S.NUM_ZONES), grain="day", out_time="day")


@register("month_files", S.base_ctes() + " SELECT zone_id, hour, demand FROM hourly")
def q_month_files(spark, sf_dir):
    """Month files as the trip publisher names them: written, then loaded and cleaned in one scan."""
    base = shared_path(spark, "month-files")
    trips = read_events_trips(spark, sf_dir)
    stamp = F.date_format("pickup_datetime", "yyyy-MM")
    months = sorted(r[0] for r in trips.where(F.col("pickup_datetime").isNotNull()).select(stamp).distinct().collect())
    for m in months:                                        # one job a month; the publisher's files come one by one
        trips.where(stamp == m).write.parquet(f"{base}/fhvhv_tripdata_{m}.parquet")
    return aggregate(read_months(spark, base, [(int(m[:4]), int(m[5:])) for m in months], num_zones=S.NUM_ZONES))


# -------------------------------------------------------------- zone CSV ---

_CSV_IDS = """CASE WHEN s_suppkey % 7 = 0 THEN 'S' || s_suppkey WHEN s_suppkey % 11 = 0 THEN '' WHEN s_suppkey % 5 = 0
  THEN ' ' || s_suppkey || ' ' ELSE CAST(s_suppkey AS VARCHAR) END"""
_CSV_SQL = f"""WITH z AS (SELECT {_CSV_IDS} AS id, r_name AS Borough, s_name AS Zone, CASE WHEN s_suppkey % 3 = 0 THEN 'N/A' ELSE n_name END AS service_zone
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""


def _zone_csv(spark, sf_dir) -> str:
    """The zone dimension as a CSV in another order of columns, with some ids that are none."""
    path = shared_path(spark, "zone-csv")
    key = F.col("LocationID")
    text = key.cast("string")
    ids = (F.when(key % 7 == 0, F.concat(F.lit("S"), text)).when(key % 11 == 0, F.lit(""))
           .when(key % 5 == 0, F.concat(F.lit(" "), text, F.lit(" "))).otherwise(text))
    zone = F.when(key % 3 == 0, F.lit("N/A")).otherwise(F.col("service_zone"))
    rows = C.zone_dim(spark, sf_dir).select("Zone", zone.alias("service_zone"), "Borough", ids.alias("LocationID"))
    rows.write.option("header", True).option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@register("zone_lookup_csv", _CSV_SQL + """ SELECT CAST(trim(id) AS BIGINT) AS LocationID, Borough, Zone, service_zone FROM z
  WHERE regexp_matches(id, '^ *[0-9]+ *$')""")
def q_zone_lookup_csv(spark, sf_dir):
    zones, _ = read_zone_lookup(spark, _zone_csv(spark, sf_dir))
    return zones


@register("zone_lookup_rejects", _CSV_SQL + """ SELECT concat_ws(',', Zone, service_zone, Borough, nullif(id, '')) || CASE WHEN id = '' THEN ',' ELSE '' END AS record,
  CASE WHEN id = '' THEN 'no id' ELSE 'id is no integer' END AS reason FROM z WHERE NOT regexp_matches(id, '^ *[0-9]+ *$')""")
def q_zone_lookup_rejects(spark, sf_dir):
    _, rejected = read_zone_lookup(spark, _zone_csv(spark, sf_dir))
    return rejected


# ----------------------------------------------------------- stored models ---

_OLS_METRICS_SQL = (C.FEATS_SQL + C._OLS_SQL + """,
  scored AS (SELECT t.demand, t.lag_24h, c.b0 + c.b1 * t.lag_1h + c.b2 * t.lag_24h AS prediction FROM test t, coef c)
  SELECT """ + C._metric_sql("demand", "prediction", "model_", False) + ", " + C._metric_sql("demand", "lag_24h", "baseline_", False) + " FROM scored")


@register("saved_model_metrics", _OLS_METRICS_SQL)
def q_saved_model_metrics(spark, sf_dir):
    """Fitted, saved, loaded into an object with other columns, scored: the contract decides."""
    train, test = C._train_test(spark, sf_dir)
    path = shared_path(spark, "saved-model")
    DemandForecaster(feature_columns=("lag_24h",)).fit(train).save(path)           # an earlier version
    DemandForecaster().fit(train).save(path)
    return round_doubles(evaluate_model(DemandForecaster(feature_columns=("lag_24h",), target_column="other").load(path), test))


@register("column_model_metrics", _OLS_METRICS_SQL)
def q_column_model_metrics(spark, sf_dir):
    """The same scores from the saved coefficients alone: a column expression, no Spark ML state."""
    train, test = C._train_test(spark, sf_dir)
    path = shared_path(spark, "column-model")
    DemandForecaster().fit(train).save(path)
    return round_doubles(evaluate_model(LinearColumns.from_saved(path), test))


@register("forest_nodes", C.FEATS_SQL + """ SELECT (SELECT count(*) FROM test) AS n_rows, CAST(50 AS BIGINT) AS n_trees,
  CAST(0 AS BIGINT) AS unequal, CAST(0 AS BIGINT) AS lost_rows, CAST(0 AS BIGINT) AS wrong_means, TRUE AS within_depth""")
def q_forest_nodes(spark, sf_dir):
    """The forest as a stored node table: sound, and its scores by joins equal the fitted model's on every test row."""
    train, test = C._train_test(spark, sf_dir)
    model = make_pipeline("random_forest").fit(train)
    path = shared_path(spark, "forest-nodes")
    NodeForest.from_model(model).save(path)
    forest = NodeForest.load(path)
    checks = check_nodes(forest.nodes).agg(F.count(F.lit(1)).alias("n_trees"), F.sum("lost_rows").alias("lost_rows"),
                                           F.sum("wrong_means").alias("wrong_means"), (F.max("depth") <= forest.depth).alias("within_depth"))
    # Spark ML's own score of the distinct vectors, so that the two sides meet on the features alone
    vectors = materialized(test.groupBy("lag_1h", "lag_24h").agg(F.count(F.lit(1)).alias("n")), "parquet")
    own = model.transform(vectors).select("lag_1h", "lag_24h", "n", F.col("prediction").alias("own"))
    both = forest.transform(own)
    off = F.abs(F.col("prediction") - F.col("own")) > F.lit(1e-9) * F.greatest(F.lit(1.0), F.abs("own"))
    scores = both.agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(off, F.col("n"))), F.lit(0)).alias("unequal"))
    one = scores.select("n_rows", "unequal", *[checks.select(c).scalar().alias(c) for c in ("n_trees", "lost_rows", "wrong_means", "within_depth")])
    return one.select("n_rows", "n_trees", "unequal", "lost_rows", "wrong_means", "within_depth")


# ------------------------------------------------------------------ sinks ---


@register("sorted_panel", S.base_ctes() + """ SELECT zone_id, hour, demand, row_number() OVER (ORDER BY zone_id, hour) - 1 AS position FROM hourly""")
def q_sorted_panel(spark, sf_dir):
    """The panel through the sorted sink: where each row lies in the files."""
    path = shared_path(spark, "sorted-panel")
    write_sorted(C.hourly(spark, sf_dir), path, ("zone_id", "hour"))
    return read_positions(spark, path)


@register("sorted_links", C._PAGE_HREF_SQL + r""",
  words AS (SELECT lower(regexp_extract(href, '^/(\p{L}+)$', 1)) AS term, href AS url, page_id, pos FROM hrefs WHERE regexp_matches(href, '^/(\p{L}+)$')),
  firsts AS (SELECT url, min(struct_pack(page_id := page_id, pos := pos, term := term)) AS f FROM words GROUP BY url)
  SELECT f.term AS term, url, f.page_id AS page_id, f.pos AS pos, row_number() OVER (ORDER BY f.term, f.page_id, f.pos) - 1 AS position FROM firsts""")
def q_sorted_links(spark, sf_dir):
    """The link catalogue in its order: by term, ties in document order."""
    found = L.extract_links(table(spark, sf_dir, "pages"), C._WORD_RE, {"term": (1, "lower")})
    path = shared_path(spark, "sorted-links")
    write_sorted(found.select("term", "url", "page_id", "pos"), path, ("term", "page_id", "pos"))
    return read_positions(spark, path)


@register("bucketed_demand", S.base_ctes() + ", " + C._DIM_SQL + ", " + C._DIM1_SQL + """
  SELECT h.zone_id, d.Borough AS borough, count(*) AS n_hours, CAST(sum(h.demand) AS BIGINT) AS demand
  FROM hourly h JOIN dimu d ON h.zone_id = d.LocationID GROUP BY 1, 2""")
def q_bucketed_demand(spark, sf_dir):
    """Panel and zones as tables bucketed by zone: joined and grouped where they lie."""
    panel, dim = C.hourly(spark, sf_dir), ZoneResolver(C.zone_dim(spark, sf_dir)).dim.withColumnRenamed("LocationID", "zone_id")
    names = [write_bucketed(panel, shared_path(spark, "bucketed-panel"), ("zone_id",), 8, ("hour",)),
             write_bucketed(dim, shared_path(spark, "bucketed-zones"), ("zone_id",), 8)]
    left, right = (spark.table(n) for n in names)
    joined = left.hint("merge").join(right, "zone_id")
    return joined.groupBy("zone_id", F.col("Borough").alias("borough")).agg(
        F.count(F.lit(1)).alias("n_hours"), F.sum("demand").cast("bigint").alias("demand"))


@register("row_positions", S.base_ctes() + " SELECT zone_id, hour, demand, row_number() OVER (ORDER BY hour, zone_id) - 1 AS pos FROM hourly")
def q_row_positions(spark, sf_dir):
    """The place of every panel row in the order of time, without a sort in one task."""
    return with_positions(C.hourly(spark, sf_dir), ("hour", "zone_id"))


# ----------------------------------------------------------- guards, footers ---

_GUARDED = ("pickup_datetime", "PULocationID", "DOLocationID", "tip")


@register("guard_report", "WITH " + S.trips_cte() + """, n AS (SELECT count(*) AS n, count(pickup_datetime) AS t, count(PULocationID) AS p, count(DOLocationID) AS d,
    count(*) FILTER (WHERE PULocationID IS NOT NULL AND DOLocationID IS NOT NULL) AS w FROM trips)
  SELECT * FROM (VALUES ('required', 'pickup_datetime', TRUE, NULL), ('required', 'PULocationID', TRUE, NULL), ('required', 'DOLocationID', TRUE, NULL),
    ('required', 'tip', FALSE, NULL), ('numeric', 'PULocationID', TRUE, NULL), ('numeric', 'pickup_datetime', FALSE, NULL), ('time', 'pickup_datetime', TRUE, NULL),
    ('time', 'DOLocationID', FALSE, NULL)) g("guard", "column", passed, n_bad)
  UNION ALL SELECT 'complete', 'PULocationID', p > 0, n - p FROM n UNION ALL SELECT 'complete', 'DOLocationID', d > 0, n - d FROM n
  UNION ALL SELECT 'complete', '*', w > 0, n - w FROM n""")
def q_guard_report(spark, sf_dir):
    """What the guards find in the raw trips, one missing and two wrongly typed columns included."""
    return guard_report(read_events_trips(spark, sf_dir), required=_GUARDED, numeric=("PULocationID", "pickup_datetime"),
                        times=("pickup_datetime", "DOLocationID"), complete=("PULocationID", "DOLocationID"))


_ITEM_COLUMNS = (("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"),
                 ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"))


@register("footer_stats", " UNION ALL ".join(
    f"""SELECT '{name}' AS "column", '{kind}' AS type, count(*) AS n_rows, count(*) - count({name}) AS n_nulls, """
    + (f"CAST(min({name}) AS VARCHAR) AS min_value, CAST(max({name}) AS VARCHAR) AS max_value" if kind in ("bigint", "int")
       else "CAST(NULL AS VARCHAR) AS min_value, CAST(NULL AS VARCHAR) AS max_value") + " FROM lineitem" for name, kind in _ITEM_COLUMNS))
def q_footer_stats(spark, sf_dir):
    """Row and null counts of every column and the bounds of whole numbers, from Parquet footers."""
    return footer_stats(spark, f"{sf_dir}/lineitem.parquet")
