import datetime as dt

import pandas as pd
import pytest

from zonecast.operators.groups import apply_per_zone


def panel(spark):
    start = dt.datetime(2026, 1, 1)
    rows = [(z, start + dt.timedelta(hours=h), z * h) for z in (4, 13, 24, 132) for h in (1, 0)]
    rows.append((None, start, 5))
    return spark.createDataFrame(rows, "zone_id bigint, hour timestamp_ntz, demand bigint")


def diff(pdf: pd.DataFrame) -> pd.DataFrame:
    out = pdf[["zone_id", "hour", "demand"]].copy()
    out["delta"] = out["demand"].diff().fillna(0).astype("int64")
    return out


def test_matches_sequential_pandas(spark):
    df = panel(spark)
    got = apply_per_zone(df, diff, "zone_id bigint, hour timestamp_ntz, demand bigint, delta bigint") \
        .orderBy("zone_id", "hour").toPandas()
    pdf = df.toPandas().dropna(subset=["zone_id"]).sort_values(["zone_id", "hour"])
    want = pd.concat([diff(g) for _, g in pdf.groupby("zone_id")]).reset_index(drop=True)
    assert got["delta"].tolist() == want["delta"].tolist()
    assert got["zone_id"].tolist() == want["zone_id"].astype("int64").tolist()


def test_row_count_may_change(spark):
    out = apply_per_zone(panel(spark), lambda p: p.head(1), "zone_id bigint, hour timestamp_ntz, demand bigint")
    assert out.count() == 4 and out.columns == ["zone_id", "hour", "demand"]


def test_guards(spark):
    with pytest.raises(ValueError):
        apply_per_zone(panel(spark), diff, "x int", group_column="nope")
    with pytest.raises(ValueError):
        apply_per_zone(panel(spark), "not callable", "x int")


def test_worker_count_does_not_change_result(spark):
    schema = "zone_id bigint, hour timestamp_ntz, demand bigint, delta bigint"
    a = apply_per_zone(panel(spark), diff, schema, n_workers=1).orderBy("zone_id", "hour").collect()
    b = apply_per_zone(panel(spark), diff, schema, n_workers=7).orderBy("zone_id", "hour").collect()
    assert a == b
    for bad in (0, -2, 1.5, True):
        with pytest.raises(ValueError):
            apply_per_zone(panel(spark), diff, schema, n_workers=bad)


def test_groups_that_span_batches(spark):
    start = dt.datetime(2026, 1, 1)
    rows = [(z, start + dt.timedelta(hours=h), h) for z, n in ((1, 7), (2, 1), (3, 20), (4, 3), (5, 1)) for h in range(n)]
    df = spark.createDataFrame(rows[::-1], "zone_id bigint, hour timestamp_ntz, demand bigint")
    schema = "zone_id bigint, n bigint, ordered boolean, kind string"

    def summary(p):
        return pd.DataFrame({"zone_id": [p["zone_id"].iloc[0]], "n": [len(p)], "ordered": [p["hour"].is_monotonic_increasing], "kind": [str(p["hour"].dtype)]})
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (1, 2, 3, 1000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = sorted(map(tuple, apply_per_zone(df, summary, schema, n_workers=2).collect()))
            assert got == [(1, 7, True, "datetime64[ns]"), (2, 1, True, "datetime64[ns]"), (3, 20, True, "datetime64[ns]"),
                           (4, 3, True, "datetime64[ns]"), (5, 1, True, "datetime64[ns]")]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    none = apply_per_zone(df, lambda p: p.head(0), "zone_id bigint, hour timestamp_ntz, demand bigint")
    assert none.count() == 0 and apply_per_zone(df.limit(0), summary, schema).count() == 0


def test_a_filled_grid_is_not_shuffled_again(spark):
    from zonecast.operators.demand import fill_grid
    g = fill_grid(panel(spark).where("zone_id is not null"))
    plan = apply_per_zone(g, diff, "zone_id bigint, hour timestamp_ntz, demand bigint, delta bigint")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(zone_id") == g._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(zone_id")
