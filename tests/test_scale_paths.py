"""Plan-shape and alternate-path tests: the code paths a large cluster takes."""

import datetime as dt
import re

from pyspark.sql import functions as F

from conftest import ts
from zonecast.operators.calendar import add_calendar_features
from zonecast.operators.demand import aggregate, grid
from zonecast.operators.links import anchor_hrefs
from zonecast.operators.reports import column_profile
from zonecast.operators.zones import ZoneResolver

SCHEMA = "pickup_datetime timestamp_ntz, PULocationID bigint, DOLocationID bigint"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_combined_before_the_shuffle(spark):
    start = dt.datetime(2026, 1, 1)
    rows = [(start + dt.timedelta(minutes=i % 600), 7, 1) for i in range(3000)]          # hot zone: 1/3+
    rows += [(start + dt.timedelta(minutes=i % 600), 1 + i % 50, 1) for i in range(5000)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = aggregate(df)
    plan = _plan(out)
    assert re.search(r"partial_count.*\n.*", plan) or "partial_count" in plan
    assert plan.index("partial_count") > plan.index("Exchange")        # partial agg sits below the exchange
    totals = {r.zone_id: r.n for r in out.groupBy("zone_id").agg(F.sum("demand").alias("n")).collect()}
    assert totals[7] == 3000 + sum(1 for i in range(5000) if 1 + i % 50 == 7)
    assert sum(totals.values()) == 8000


def test_zone_resolver_shuffle_join_path(spark):
    dim = spark.createDataFrame([(1, "A", "z1", "s"), (2, "B", "z2", "s")],
                                "LocationID bigint, Borough string, Zone string, service_zone string")
    trips = spark.createDataFrame([(ts("2026-01-01 08:00"), 1, 2), (ts("2026-01-01 08:00"), 3, 2)], SCHEMA)
    zones = ZoneResolver(dim)
    assert "SinglePartition" not in _plan(zones.annotate(trips))        # no size probe
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = zones.annotate(trips)
        assert "SortMergeJoin" in _plan(out)
        assert {r.PULocationID: r.PU_zone for r in out.collect()} == {1: "z1", 3: None}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    twice = zones.annotate(zones.annotate(trips))
    assert twice.columns.count("PU_zone") == 1


def test_column_profile_does_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (2, None), (1, 99)], "a bigint, b bigint")
    out = column_profile(df, ["a", "b"], lo=1, hi=10)
    assert "Expand" not in _plan(out)
    got = {r.column: tuple(r)[2:] for r in out.collect()}
    assert got == {"a": (1, "1", "2", 2, 0), "b": (1, "5", "99", 2, 1)}


def test_grid_shuffles_one_row_per_key_and_task(spark):
    rows = [(z, ts("2026-01-01 00:00") + dt.timedelta(hours=h), 1) for z in range(3) for h in range(50)]
    panel = spark.createDataFrame(rows, "zone_id bigint, hour timestamp_ntz, demand bigint")
    plan = _plan(grid(panel))
    assert plan.index("REPARTITION_BY_NUM") < plan.index("HashAggregate(keys=[zone_id")      # the distinct stands below


def test_holidays_from_a_dataframe(spark):
    hol = spark.createDataFrame([(dt.date(2026, 3, 15),)], "d date")
    df = spark.createDataFrame([(ts("2026-03-15 10:00"),), (ts("2026-03-16 10:00"),)], "hour timestamp_ntz")
    out = add_calendar_features(df, hol).orderBy("hour").collect()
    assert [r.is_holiday for r in out] == [1, 0]


def test_href_quoting_forms(spark):
    html = """<a href='/single'>s</a><A HREF=/bare>b</A><a class="x" href = " /spaced " >c</a>
              <a title="href=/fake">t</a><abbr href="/not-anchor">x</abbr>"""
    pages = spark.createDataFrame([(1, html), (2, None)], "page_id bigint, html string")
    got = [r.href for r in anchor_hrefs(pages).orderBy("pos").collect()]
    assert got == ["/single", "/bare", "/spaced"]


def test_grid_partitions_sized_from_cells(spark):
    rows = [(z, ts("2026-01-01 00:00"), 1) for z in range(3)] + [(0, ts("2026-01-03 23:00"), 1)]
    panel = spark.createDataFrame(rows, "zone_id bigint, hour timestamp_ntz, demand bigint")
    g = grid(panel)
    assert g.count() == 3 * 72
    assert g.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert dict(g.dtypes)["hour"] == "timestamp_ntz"
