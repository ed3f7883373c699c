import datetime as dt

import pytest

from zonecast.plans.forecast import forecast_report
from zonecast.sources.trips import read_months

SCHEMA = "pickup_datetime timestamp_ntz, PULocationID bigint, DOLocationID bigint"


def _trips(spark, days=4, zones=(1, 2, 3)):
    start = dt.datetime(2026, 1, 1)
    rows = []
    for d in range(days):
        for h in range(24):
            for z in zones:
                for i in range((h + z + d) % 4 + 1):
                    rows.append((start + dt.timedelta(days=d, hours=h, minutes=7 * i), z, 1))
    return spark.createDataFrame(rows, SCHEMA)


def test_forecast_report_end_to_end(spark):
    dim = spark.createDataFrame([(1, "B1", "Z1", "S"), (2, "B2", "Z2", "S")],
                                "LocationID bigint, Borough string, Zone string, service_zone string")
    rep = forecast_report(_trips(spark), dim, top_k=2)
    m = rep.metrics.first().asDict()
    assert set(m) == {"model_mae", "model_rmse", "baseline_mae", "baseline_rmse", "model_mape", "baseline_mape"}
    models = {r.model for r in rep.model_table.collect()}
    assert models == {"linear", "ridge", "random_forest", "baseline-lag24"}
    top = rep.top_k.orderBy("rank").collect()
    assert [r.rank for r in top] == [1, 2]
    assert top[0].predicted_demand >= top[1].predicted_demand
    names = {r.zone_id: r.zone_name for r in top}
    assert all(n.startswith(f"zone {z} (") for z, n in names.items())
    assert len({r.hour for r in top}) == 1


def test_read_months_one_scan(spark, tmp_path):
    base = str(tmp_path)
    for m in (1, 2):
        spark.createDataFrame([(dt.datetime(2026, m, 3, 8), 1, 2), (dt.datetime(2026, m, 3, 9), 0, 2)], SCHEMA) \
             .write.parquet(f"{base}/fhvhv_tripdata_2026-{m:02d}.parquet")
    df = read_months(spark, base, [(2026, 1), (2026, 2)])
    assert df.count() == 2
    with pytest.raises(ValueError):
        read_months(spark, base, [])
    with pytest.raises(FileNotFoundError):
        read_months(spark, base, [(2026, 3)])
