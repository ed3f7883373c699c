import datetime as dt

from zonecast.operators.demand import aggregate
from zonecast.streaming.hourly import hourly_demand_stream, start_hourly_demand

SCHEMA = "pickup_datetime timestamp_ntz, PULocationID bigint, DOLocationID bigint"


def _write(spark, path, hours):
    start = dt.datetime(2026, 1, 1)
    rows = [(start + dt.timedelta(hours=h, minutes=m), z, 1) for h in hours for z in (1, 2) for m in (5, 35)]
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(path)
    return rows


def test_stream_matches_batch_in_complete_mode(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = _write(spark, src, range(6))
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    q = (hourly_demand_stream(stream).writeStream.outputMode("complete").format("memory")
         .queryName("hourly_cmp").option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = {(r.zone_id, r.hour, r.demand) for r in spark.sql("SELECT * FROM hourly_cmp").collect()}
    want = {(r.zone_id, r.hour, r.demand) for r in aggregate(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def test_append_emits_only_closed_hours(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _write(spark, src, range(4))
    q = start_hourly_demand(spark.readStream.schema(SCHEMA).parquet(src), out, str(tmp_path / "ck"),
                            trigger_seconds=None)
    q.processAllAvailable()
    _write(spark, src, [10])          # advances the watermark past hours 0..3
    q.processAllAvailable()
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(out)
    assert {r.hour.hour for r in got.collect()} == {0, 1, 2, 3}
    assert {r.demand for r in got.collect()} == {2}


def test_late_rows_after_the_watermark_are_dropped(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _write(spark, src, range(3))
    q = start_hourly_demand(spark.readStream.schema(SCHEMA).parquet(src), out, str(tmp_path / "ck"),
                            trigger_seconds=None)
    q.processAllAvailable()
    _write(spark, src, [12])          # watermark moves to 11:00; hours 0..2 are emitted and closed
    q.processAllAvailable()
    q.processAllAvailable()
    _write(spark, src, [1])           # late: hour 1 again, behind the watermark
    q.processAllAvailable()
    _write(spark, src, [20])          # move the watermark again
    q.processAllAvailable()
    q.processAllAvailable()
    q.stop()
    rows = spark.read.parquet(out).collect()
    per_cell = {}
    for r in rows:
        per_cell[(r.zone_id, r.hour)] = per_cell.get((r.zone_id, r.hour), 0) + 1
    assert all(n == 1 for n in per_cell.values())            # each closed hour emitted once
    assert {r.demand for r in rows if r.hour.hour == 1} == {2}   # the late rows did not change it
