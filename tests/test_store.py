"""Sources, sinks and stored models: layouts, plans and edge cases."""

import datetime as dt

import duckdb
import numpy as np
import pytest
from conftest import ts
from pyspark.sql import functions as F

from zonecast.functions.guards import guard_report
from zonecast.ml.columns import ColumnModel, LinearColumns
from zonecast.ml.forecaster import DemandForecaster, saved_versions
from zonecast.ml.forest_nodes import NodeForest, check_nodes, node_table, score_by_nodes
from zonecast.ml.models import make_pipeline
from zonecast.operators.reports import column_profile
from zonecast.sources.month_store import months_between, read_month_range, read_month_store, stored_months, write_months
from zonecast.sources.sinks import read_positions, write_bucketed, write_sorted
from zonecast.sources.trips import footer_stats
from zonecast.sources.zones import load_zone_lookup, read_zone_lookup


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ----------------------------------------------------------------- months ---

def trips(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def store(spark, trips_schema, tmp_path):
    start = ts("2025-11-20 00:00")
    rows = [(start + dt.timedelta(hours=7 * i), i % 9 + 1, i % 4 + 1) for i in range(600)] + [(None, 1, 1)]
    base = str(tmp_path / "store")
    write_months(trips(spark, rows, trips_schema), base, rows_per_file=50)
    return base, rows


def test_month_store_lists_and_reads_only_what_is_wanted(spark, store):
    base, rows = store
    have = sorted((r.year, r.month) for r in stored_months(spark, base).collect())
    assert have == sorted({(t.year, t.month) for t, _, _ in rows if t})
    lo, hi = ts("2025-12-05 06:00"), ts("2026-01-10 00:00")
    df = read_month_store(spark, base, months_between(lo, hi), start=lo, end=hi)
    assert sorted(map(tuple, df.collect())) == sorted(r for r in rows if r[0] and lo <= r[0] < hi)
    assert {f.split("/store/")[1].rsplit("/", 1)[0] for f in df.inputFiles()} == {"year=2025/month=12", "year=2026/month=1"}
    plan = plan_of(df)
    pushed = plan.split("PushedFilters: [")[1]
    assert "GreaterThanOrEqual(pickup_datetime" in pushed and "LessThan(" in pushed
    assert read_month_range(spark, base, lo, hi, num_zones=5).where("PULocationID > 5").count() == 0


def test_month_store_replaces_only_the_months_written(spark, store, trips_schema):
    base, rows = store
    write_months(trips(spark, [(ts("2025-12-24 12:00"), 7, 7)], trips_schema), base)
    months = [(r.year, r.month) for r in stored_months(spark, base).collect()]
    got = [tuple(r) for r in read_month_store(spark, base, months).collect()]
    assert sorted(got) == sorted([r for r in rows if r[0] and (r[0].year, r[0].month) != (2025, 12)] + [(ts("2025-12-24 12:00"), 7, 7)])


def test_month_store_files_are_sorted_and_follow_the_row_count(spark, store):
    base, _ = store
    df = spark.read.parquet(base).where("year = 2026 and month = 1")
    files = df.select(F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"), "pickup_datetime").collect()
    assert len({r.f for r in files}) <= -(-len(files) // 50)
    by_file = {}
    for r in sorted(files, key=lambda r: (r.f, r.i)):
        by_file.setdefault(r.f, []).append(r.pickup_datetime)
    if len(by_file) == -(-len(files) // 50):          # no two shares met in one task
        assert all(times == sorted(times) for times in by_file.values())


def test_month_store_errors(spark, store, trips_schema, tmp_path):
    base, _ = store
    with pytest.raises(FileNotFoundError):
        read_month_store(spark, base, [(2025, 12), (2031, 1)])
    for months in ([], [(2025, 13)], [(2018, 1)], [(2025, True)], [("2025", 1)]):
        with pytest.raises(ValueError):
            read_month_store(spark, base, months)
    with pytest.raises(ValueError, match="missing required columns"):
        read_month_store(spark, base, [(2025, 12)], columns=("pickup_datetime", "tip"))
    with pytest.raises(ValueError):
        write_months(trips(spark, [], trips_schema + ", year int"), str(tmp_path / "x"))
    with pytest.raises(ValueError):
        read_month_range(spark, base, ts("2025-12-01 00:00"), ts("2025-12-01 00:00"))
    assert months_between(ts("2025-11-30 23:00"), ts("2026-02-01 00:00")) == [(2025, 11), (2025, 12), (2026, 1)]


# ----------------------------------------------------------------- forest ---

@pytest.fixture(scope="module")
def forest(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 30, 1500).astype(float), rng.normal(0, 1, 1500)
    rows = [(i, float(x), float(z), float(x * 2 + (z > 0.3) * 7 + rng.normal())) for i, (x, z) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "zone_id int, lag_1h double, lag_24h double, demand double").cache()
    return df, make_pipeline("random_forest").fit(df)


def test_node_table_scores_like_the_model_and_like_sql(spark, forest, tmp_path):
    df, model = forest
    nodes = NodeForest.from_model(model)
    nodes.save(str(tmp_path / "nodes"))
    again = NodeForest.load(str(tmp_path / "nodes"))
    assert again.feature_columns == ["lag_1h", "lag_24h"] and again.n_trees == 50 and again.nodes.columns == nodes.nodes.columns
    odd = spark.createDataFrame([(2000, None, 1.0, 0.0), (2001, 1e9, -1e9, 0.0), (2002, 5.0, 0.3, 0.0)], df.schema)
    test = df.unionByName(odd)
    want = {r.zone_id: r.prediction for r in model.transform(test.dropna(subset=["lag_1h", "lag_24h"])).collect()}
    got = {r.zone_id: r.prediction for r in again.transform(test).collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9

    con = duckdb.connect()
    test.select("zone_id", "lag_1h", "lag_24h").write.parquet(str(tmp_path / "rows"))
    sql = con.execute(f"""WITH RECURSIVE n AS (SELECT * FROM read_parquet('{tmp_path}/nodes/*.parquet')),
      r AS (SELECT * FROM read_parquet('{tmp_path}/rows/*.parquet') WHERE lag_1h IS NOT NULL AND lag_24h IS NOT NULL),
      walk AS (SELECT zone_id, lag_1h, lag_24h, tree, 0 AS node FROM r, (SELECT DISTINCT tree FROM n)
        UNION ALL SELECT zone_id, lag_1h, lag_24h, tree,
          CASE WHEN (CASE feature WHEN 'lag_1h' THEN lag_1h ELSE lag_24h END) <= threshold THEN left_child ELSE right_child END
        FROM walk JOIN n USING (tree, node) WHERE feature IS NOT NULL)
      SELECT zone_id, avg(value) FROM walk JOIN n USING (tree, node) WHERE feature IS NULL GROUP BY zone_id""").fetchall()
    assert len(sql) == len(want) and max(abs(p - want[k]) for k, p in sql) < 1e-9


def test_node_table_is_sound_and_checks_find_damage(spark, forest):
    _, model = forest
    nodes = node_table(model)
    checks = check_nodes(nodes).collect()
    assert len(checks) == 50 and all(r.lost_rows == 0 and r.wrong_means == 0 and 0 < r.depth <= 10 and r.n_nodes == 2 * r.n_leaves - 1 for r in checks)
    root = (F.col("tree") == 3) & (F.col("node") == 0)
    bad = nodes.withColumn("value", F.when(root, F.col("value") + 1).otherwise(F.col("value"))).withColumn(
        "n_rows", F.when(root, F.col("n_rows") + 1).otherwise(F.col("n_rows")))
    r = check_nodes(bad).where("tree = 3").first()
    assert (r.lost_rows, r.wrong_means) == (1, 1)


def test_scoring_by_nodes_shuffles_no_rows_by_tree(spark, forest):
    df, model = forest
    f = NodeForest.from_model(model)
    plan = plan_of(score_by_nodes(df, f.nodes, f.feature_columns, depth=f.depth, n_trees=f.n_trees))
    assert "CartesianProduct" not in plan and "hashpartitioning(_tree" not in plan


def test_only_forests_have_node_tables(forest):
    df, _ = forest
    with pytest.raises(ValueError):
        node_table(make_pipeline("linear").fit(df))


# ----------------------------------------------------------- stored models ---

def test_versions_commit_last_and_load_the_latest(spark, forest, tmp_path):
    df, _ = forest
    path = str(tmp_path / "m")
    first = DemandForecaster(feature_columns=("lag_24h",)).fit(df).save(path)
    second = DemandForecaster().fit(df).save(path)
    assert [(r.version, r.place) for r in saved_versions(path).orderBy("place").collect()] == [(first, 1), (second, 2)]
    # a save that was broken off: a pipeline without its contract row
    DemandForecaster(feature_columns=("lag_1h",)).fit(df).model.write().save(f"{path}/versions/half")
    assert DemandForecaster().load(path).feature_columns == ["lag_1h", "lag_24h"]
    assert DemandForecaster().load(path, first).feature_columns == ["lag_24h"]
    with pytest.raises(FileNotFoundError):
        DemandForecaster().load(path, "half")
    with pytest.raises(RuntimeError):
        DemandForecaster().save(path)


def test_column_models_score_like_the_pipeline(spark, forest, tmp_path):
    df, _ = forest
    m = DemandForecaster().fit(df)
    path = str(tmp_path / "m")
    version = m.save(path)
    lin = LinearColumns.from_saved(path, version)
    a = {r.zone_id: r.prediction for r in m.transform(df).collect()}
    assert all(abs(a[r.zone_id] - r.prediction) < 1e-9 for r in lin.transform(df).collect())
    assert "Python" not in plan_of(lin.transform(df)) and "UDF" not in plan_of(lin.transform(df))
    half = ColumnModel(["lag_1h"], lambda c: c["lag_1h"] / 2)
    assert half.predict(df).where("prediction <> lag_1h / 2").count() == 0
    with pytest.raises(FileNotFoundError):
        LinearColumns.from_saved(str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        LinearColumns.from_saved(path, "other")


# -------------------------------------------------------------- zone CSV ---

def test_lines_that_do_not_fit_become_rows(spark, tmp_path):
    p = tmp_path / "z.csv"
    p.write_text('Zone,extra,LocationID,Borough,service_zone\n"A, B",e, 7 ,Queens,N/A\nC,,x9,Bronx,\nshort,e\nD,e,8,Bronx,Y,more\nE,e,,Bronx,Y\nF,e,9.5,Q,Y\n')
    zones, rejected = read_zone_lookup(spark, str(p))
    assert [tuple(r) for r in zones.collect()] == [(7, "Queens", "A, B", "N/A")]
    got = sorted((r.reason, r.record) for r in rejected.collect())
    assert got == [("id is no integer", "C,,x9,Bronx,"), ("id is no integer", "F,e,9.5,Q,Y"), ("malformed", "D,e,8,Bronx,Y,more"),
                   ("malformed", "short,e"), ("no id", "E,e,,Bronx,Y")]
    with pytest.raises(ValueError, match="integer"):
        load_zone_lookup(spark, str(p))
    assert load_zone_lookup(spark, str(p), validate=False).count() == 1


# ------------------------------------------------------------------ sinks ---

def test_sorted_sink_keeps_order_across_files(spark, tmp_path):
    rows = [((i * 7919) % 1000, None if i % 50 == 0 else i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    path = str(tmp_path / "s")
    write_sorted(df, path, ("k", "v"))
    back = read_positions(spark, path).orderBy("position").collect()
    assert [r.position for r in back] == list(range(1000)) and [r.k for r in back] == sorted(r[0] for r in rows)
    write_sorted(df.limit(0), str(tmp_path / "e"), ("k",))
    assert read_positions(spark, str(tmp_path / "e")).count() == 0
    with pytest.raises(ValueError):
        write_sorted(df, path, ("nope",))
    with pytest.raises(ValueError):
        read_positions(spark, path, position="k")


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    left = spark.range(3000).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    right = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    names = [write_bucketed(left, str(tmp_path / "l"), ("k",), 4, ("v",)), write_bucketed(right, str(tmp_path / "r"), ("k",), 4)]
    joined = spark.table(names[0]).hint("merge").join(spark.table(names[1]), "k").groupBy("k").agg(F.sum("w").alias("s"))
    assert "Exchange" not in plan_of(joined) and joined.where("s <> 60 * k").count() == 0 and joined.count() == 100
    for n in names:
        spark.sql(f"DROP TABLE {n}")
    assert spark.read.parquet(str(tmp_path / "l")).count() == 3000          # external: the files stay
    with pytest.raises(ValueError):
        write_bucketed(left, str(tmp_path / "x"), ("k",), 0)


# --------------------------------------------------- guards, footers, profile ---

def test_guard_report_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, "y")], "a int, b double, c string")
    got = {(r.guard, r.column): (r.passed, r.n_bad) for r in
           guard_report(df, required=("a", "z"), numeric=("b", "c", "z"), times=("a",), complete=("a", "b")).collect()}
    assert got == {("required", "a"): (True, None), ("required", "z"): (False, None), ("numeric", "b"): (True, None), ("numeric", "c"): (False, None),
                   ("numeric", "z"): (False, None), ("time", "a"): (False, None), ("complete", "a"): (True, 1), ("complete", "b"): (False, 2),
                   ("complete", "*"): (False, 2)}
    lost = {(r.column): (r.passed, r.n_bad) for r in guard_report(df.limit(0), complete=("a", "q")).collect()}
    assert lost == {"a": (False, 0), "q": (False, None), "*": (False, None)}


def test_footer_stats_are_pushed_down(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).alias("s"), (F.col("id") / 3).alias("x"),
                                  F.array("id").alias("l"), F.date_add(F.lit(dt.date(2026, 1, 1)), F.col("id").cast("int")).alias("d"))
    path = str(tmp_path / "f")
    df.write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    out = footer_stats(spark, path)
    got = {r.column: (r.type, r.n_rows, r.n_nulls, r.min_value, r.max_value) for r in out.collect()}
    assert got == {"id": ("bigint", 1000, 0, "0", "999"), "s": ("string", 1000, 666, None, None), "x": ("double", 1000, 0, None, None),
                   "l": ("array<bigint>", 1000, None, None, None), "d": ("date", 1000, 0, "2026-01-01", "2028-09-26")}
    plan = plan_of(out)
    assert "PushedAggregation: [" in plan and "COUNT(*)" in plan and "MIN(id)" in plan and "PushedAggregation: []" not in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_column_profile_is_one_scan_of_mixed_types(spark, tmp_path):
    rows = [(1, "b", 2.5, None), (None, "a", float(10), None), (300, "a", None, None), (1, None, 2.5, None)]
    spark.createDataFrame(rows, "a int, b string, c double, e int").write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    out = column_profile(df, ["a", "b", "c", "e"], lo=1, hi=265)
    got = {r.column: tuple(r)[1:] for r in out.collect()}
    assert got == {"a": ("int", 1, "1", "300", 2, 1), "b": ("string", 1, "a", "b", 2, None), "c": ("double", 1, "2.5", "10.0", 2, 0),
                   "e": ("int", 4, None, None, 0, 0)}
    assert plan_of(column_profile(df, ["a", "b", "c", "e"])).count("Scan parquet") == 1
    empty = {r.column: tuple(r)[1:] for r in column_profile(df.limit(0), ["a", "b"]).collect()}
    assert empty == {"a": ("int", 0, None, None, 0, None), "b": ("string", 0, None, None, 0, None)}
