import pytest

from conftest import ts
from zonecast.operators.zones import (ZoneResolver, borough_demand, zones_without_demand)
from zonecast.sources.zones import load_zone_lookup

CSV = """LocationID,Borough,Zone,service_zone
1,EWR,Newark Airport,EWR
2,Queens,Jamaica Bay,Boro Zone
3,Bronx,Allerton,Boro Zone
264,Unknown,N/A,N/A
265,N/A,Outside of NYC,
"""


@pytest.fixture
def lookup_path(tmp_path):
    p = tmp_path / "lookup.csv"
    p.write_text(CSV)
    return str(p)


def test_load_lookup_types_and_na(spark, lookup_path):
    dim = load_zone_lookup(spark, lookup_path)
    assert dim.columns == ["LocationID", "Borough", "Zone", "service_zone"]
    assert dict(dim.dtypes)["LocationID"] == "bigint"
    rows = {r.LocationID: r for r in dim.collect()}
    assert rows[264].Zone == "N/A" and rows[265].Borough == "N/A"
    assert rows[265].service_zone is None


def test_load_lookup_reordered_columns(spark, tmp_path):
    p = tmp_path / "re.csv"
    p.write_text("Zone,service_zone,Borough,LocationID\nAllerton,Boro Zone,Bronx,3\n")
    r = load_zone_lookup(spark, str(p)).first()
    assert (r.LocationID, r.Borough, r.Zone, r.service_zone) == (3, "Bronx", "Allerton", "Boro Zone")


def test_load_lookup_errors(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("LocationID,Borough,Zone,service_zone\nalpha,X,Y,Z\n")
    with pytest.raises(ValueError, match="integer"):
        load_zone_lookup(spark, str(bad))
    miss = tmp_path / "miss.csv"
    miss.write_text("LocationID,Borough\n1,X\n")
    with pytest.raises(ValueError, match="missing required columns"):
        load_zone_lookup(spark, str(miss))
    with pytest.raises(FileNotFoundError):
        load_zone_lookup(spark, str(tmp_path / "nope.csv"))


def _trips(spark):
    rows = [(ts("2026-01-01 08:00"), 1, 2), (ts("2026-01-01 08:10"), 999, 3), (ts("2026-01-01 09:00"), None, 1)]
    return spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, PULocationID bigint, DOLocationID bigint")


def test_annotate_pickup_and_dropoff(spark, lookup_path):
    z = ZoneResolver(load_zone_lookup(spark, lookup_path))
    out = z.annotate(z.annotate(_trips(spark), "PULocationID", "PU"), "DOLocationID", "DO")
    assert out.count() == 3
    rows = {r.PULocationID: r for r in out.collect()}
    assert rows[1].PU_zone == "Newark Airport" and rows[1].DO_borough == "Queens"
    assert rows[999].PU_borough is None and rows[999].DO_zone == "Allerton"
    assert rows[None].PU_zone is None


def test_duplicate_ids_do_not_multiply_rows(spark):
    dim = spark.createDataFrame([(1, "A", "z1", "s"), (1, "B", "z1b", "s"), (2, "C", "z2", "s")],
                                "LocationID bigint, Borough string, Zone string, service_zone string")
    out = ZoneResolver(dim).annotate(_trips(spark))
    assert out.count() == 3


def test_labels(spark, lookup_path):
    z = ZoneResolver(load_zone_lookup(spark, lookup_path))
    ids = spark.createDataFrame([(1,), (999,)], "zone_id bigint")
    labels = {r.zone_id: r.label for r in z.label(ids).collect()}
    assert labels == {1: "zone 1 (Newark Airport, EWR)", 999: "zone 999 (unknown)"}


def test_membership(spark, lookup_path):
    dim = load_zone_lookup(spark, lookup_path)
    z = ZoneResolver(dim)
    assert z.known(_trips(spark)).count() == 1
    assert [(r.zone_id, r.n_rows) for r in z.unresolved(_trips(spark)).collect()] == [(999, 1)]
    missing = sorted(r.LocationID for r in zones_without_demand(dim, _trips(spark)).collect())
    assert missing == [2, 3, 264, 265]


def test_borough_rollup(spark, lookup_path):
    panel = spark.createDataFrame([(1, ts("2026-01-01 08:00"), 4), (3, ts("2026-01-01 08:00"), 6),
                                   (2, ts("2026-01-01 08:00"), 1), (999, ts("2026-01-01 08:00"), 5)],
                                  "zone_id bigint, hour timestamp_ntz, demand bigint")
    out = {r.borough: r.demand for r in borough_demand(panel, load_zone_lookup(spark, lookup_path)).collect()}
    assert out == {"EWR": 4, "Bronx": 6, "Queens": 1, None: 5}
