from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import demand_df, trips_df
from zonecast.operators import mart as mt
from zonecast.operators import quality as q
from zonecast.sources import driver_tables as dt
from zonecast.sources.trips import pickup_window

T0 = datetime(2024, 1, 1, 12, 0)


def test_quality_counters(spark):
    trips = trips_df(spark, [
        (T0, T0 + timedelta(minutes=20), 161, 2.4),
        (T0, T0 + timedelta(minutes=10), 999, 1.0),
        (T0, T0 + timedelta(minutes=30), 90, 500.0),
    ])
    clean = q.clean_trips(trips).collect()
    assert [r.PULocationID for r in clean] == [161]
    rep = q.quality_report(trips).first().asDict()
    assert rep["input_rows"] == 3 and rep["valid_rows"] == 1 and rep["dropped_rows"] == 2
    assert rep["invalid_zone_rows"] == 1 and rep["invalid_distance_rows"] == 1
    assert rep["null_pickup_rows"] == 0 and rep["invalid_duration_rows"] == 0
    assert rep["valid_share"] == pytest.approx(1 / 3)


def test_quality_overlapping_rules_and_duration(spark):
    trips = trips_df(spark, [
        (None, T0, 161, 1.0),                              # null pickup -> also invalid duration
        (T0, T0 - timedelta(seconds=1), 161, 1.0),         # negative duration
        (T0, T0 + timedelta(hours=8, milliseconds=700), 161, 1.0),  # 8 h 0.7 s cut to 8 h -> valid
        (T0, T0 + timedelta(hours=8, seconds=1), 161, 1.0),         # > 8 h
        (T0, T0 + timedelta(minutes=5), None, float("nan")),        # null zone, NaN distance
    ])
    rep = q.quality_report(trips).first().asDict()
    assert rep["null_pickup_rows"] == 1
    assert rep["invalid_duration_rows"] == 3
    assert rep["invalid_zone_rows"] == 1 and rep["invalid_distance_rows"] == 1
    assert rep["valid_rows"] == 1
    assert q.quality_report(trips.limit(0)).first()["valid_share"] == 0.0


def test_hourly_grid_fills_gaps(spark):
    base = datetime(2024, 1, 1, 10)
    trips = trips_df(spark, [
        (base, base + timedelta(minutes=5), 161, 1.0),
        (base + timedelta(minutes=20), base + timedelta(minutes=25), 161, 2.0),
        (base + timedelta(hours=2), base + timedelta(hours=2, minutes=5), 161, 3.0),
    ])
    mart = mt.aggregate_hourly_demand(trips).orderBy("timestamp").collect()
    assert [r.demand for r in mart] == [2, 0, 1]
    assert [r.timestamp.hour for r in mart] == [10, 11, 12]
    assert mt.aggregate_hourly_demand(trips).schema.simpleString() == "struct<timestamp:timestamp_ntz,zone_id:smallint,demand:int>"


def test_pickup_window_is_half_open(spark):
    rows = [datetime(2002, 1, 1, 12), datetime(2024, 1, 15, 12, 10), datetime(2024, 1, 15, 12, 40), datetime(2024, 2, 1, 0, 5)]
    trips = trips_df(spark, [(p, p + timedelta(minutes=5), 161, 1.0) for p in rows])
    window = pickup_window(trips, "2024-01-01 00:00:00", "2024-02-01 00:00:00")
    mart = mt.aggregate_hourly_demand(window).collect()
    assert [(r.timestamp, r.demand) for r in mart] == [(datetime(2024, 1, 15, 12), 2)]
    with pytest.raises(ValueError):
        pickup_window(trips, "2024-02-01", "2024-01-01")


def test_merge_overlap_sums(spark):
    left = demand_df(spark, [(datetime(2026, 1, 31, 23), 161, 2), (datetime(2026, 2, 1, 0), 161, 4)])
    right = demand_df(spark, [(datetime(2026, 2, 1, 0), 161, 3), (datetime(2026, 2, 1, 1), 161, 5)])
    merged = mt.merge_hourly_demand([left, right]).orderBy("timestamp").collect()
    assert [r.demand for r in merged] == [2, 7, 5]


def test_merge_regrids_missing_zones(spark):
    day = datetime(2026, 1, 1)
    left = demand_df(spark, [(day, 1, 4), (day + timedelta(hours=1), 1, 2)])
    right = demand_df(spark, [(day + timedelta(hours=2), 2, 7)])
    merged = mt.merge_hourly_demand([left, right])
    assert merged.count() == 6
    zone2 = [r.demand for r in merged.filter("zone_id = 2").orderBy("timestamp").collect()]
    assert zone2 == [0, 0, 7]
    with pytest.raises(ValueError):
        mt.merge_hourly_demand([])


def test_grid_invariants_on_driver_data(spark):
    trips = dt.trips(spark, "/root/testdata/sf0.001")
    counts = mt.aggregate_hourly_demand(trips, complete_grid=False)
    grid = mt.complete_hourly_grid(counts)
    c = counts.agg(F.sum("demand"), F.countDistinct("zone_id"), F.min("timestamp"), F.max("timestamp")).first()
    g = grid.agg(F.sum("demand"), F.count("*"), F.countDistinct("timestamp", "zone_id")).first()
    hours = int((c[3] - c[2]).total_seconds() // 3600) + 1
    assert g[0] == c[0]
    assert g[1] == g[2] == hours * c[1]


def test_grid_rejects_when_nothing_valid_remains(spark):
    trips = trips_df(spark, [(T0, T0 + timedelta(minutes=5), 999, 1.0)])
    with pytest.raises(ValueError, match="No valid trip rows"):
        mt.aggregate_hourly_demand(trips)
