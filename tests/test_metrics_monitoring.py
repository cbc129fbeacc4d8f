import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import demand_df, scored_df
from zonecast.functions import metrics as M
from zonecast.operators import diagnostics as dg
from zonecast.operators import eda
from zonecast.operators import intervals as iv
from zonecast.operators import monitoring as mon
from zonecast.operators import zones as zn
from zonecast.schemas import ZONE_LOOKUP_RAW_SCHEMA


def _metrics(spark, a, p):
    return scored_df(spark, a, p).agg(*M.forecast_metrics()).first()


def test_point_metrics(spark):
    r = _metrics(spark, [10, 20, 30], [12, 18, 33])
    assert r.mae == pytest.approx(7 / 3)
    assert r.rmse == pytest.approx(math.sqrt(17 / 3))
    assert r.wape == pytest.approx(7 / 60)
    assert r.smape == pytest.approx(np.mean([4 / 22, 4 / 38, 6 / 63]))


def test_wape_zero_demand_rule(spark):
    assert _metrics(spark, [0, 0], [0, 0]).wape == 0.0
    assert _metrics(spark, [0, 0], [1, 0]).wape == float("inf")
    assert _metrics(spark, [0, 0], [0, 0]).smape == 0.0


def test_residual_summary(spark):
    r = dg.residual_summary(scored_df(spark, [10, 20, 30, 40], [8, 21, 25, 50])).first()
    assert r.bias == pytest.approx(-1.0)
    assert r.median_absolute_error == pytest.approx(3.5)
    assert r.p90_absolute_error == pytest.approx(np.quantile([2, 1, 5, 10], 0.9))
    assert r.underprediction_share == 0.5 and r.overprediction_share == 0.5


def test_zone_and_band_tables(spark):
    t = datetime(2024, 1, 1)
    frame = spark.createDataFrame(
        [(t, 1, 10.0, 9.0), (t, 1, 10.0, 11.0), (t, 2, 10.0, 2.0), (t, 2, 10.0, 18.0)],
        "timestamp timestamp_ntz, zone_id int, target_demand double, prediction double",
    )
    rows = dg.zone_error_table(frame).collect()
    assert [r.zone_id for r in rows] == [2, 1] and [r.mae for r in rows] == [8.0, 1.0]
    bands = spark.createDataFrame(
        [(t, 1, a, p) for a, p in ((0.0, 1.0), (5.0, 4.0), (15.0, 14.0), (30.0, 29.0))],
        "timestamp timestamp_ntz, zone_id int, target_demand double, prediction double",
    )
    out = dg.demand_band_error_table(bands).collect()
    assert [r.demand_band for r in out] == ["zero", "low", "medium", "high"]
    assert all(r.observations == 1 for r in out)


def test_snapshot_and_daily(spark):
    snap = mon.performance_snapshot(scored_df(spark, [10, 20, 30, 40], [9, 18, 33, 35])).first()
    assert snap.observations == 4 and snap.mae == pytest.approx(2.75)
    ts = [datetime(2026, 1, 1, 0), datetime(2026, 1, 1, 1), datetime(2026, 1, 2, 0), datetime(2026, 1, 2, 1)]
    daily = mon.performance_by_day(scored_df(spark, [10, 20, 30, 40], [9, 18, 27, 36], timestamp=ts)).orderBy("date").collect()
    assert [r.date for r in daily] == [date(2026, 1, 1), date(2026, 1, 2)]
    assert all(r.observations == 2 and r.wape > 0 for r in daily)
    zero = mon.performance_by_day(scored_df(spark, [0], [1], timestamp=[ts[0]])).first()
    assert zero.wape == float("inf")


def test_regression_and_psi_bands(spark):
    df = spark.createDataFrame([(0.10, 0.11), (0.10, 0.12), (0.10, 0.14), (0.0, 0.0), (0.0, 0.1)], "r double, c double")
    from zonecast.functions.status import classify_performance_regression, classify_psi

    psi = spark.createDataFrame([(0.05,), (0.2,), (0.3,)], "p double")
    assert [r[0] for r in psi.select(classify_psi("p")).collect()] == ["stable", "watch", "drift"]
    with pytest.raises(Exception, match="finite"):
        df.select(classify_performance_regression(F.lit(float("nan")), "c")).collect()

    got = [r[0] for r in df.select(classify_performance_regression("r", "c")).collect()]
    assert got == ["stable", "watch", "critical", "stable", "critical"]


def test_bad_rows_are_errors_not_gaps(spark):
    import zonecast.functions.metrics as M

    frame = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "actual double, prediction double")
    with pytest.raises(Exception, match="finite"):
        frame.agg(*M.forecast_metrics()).collect()
    with pytest.raises(Exception, match="no row"):
        mon.performance_snapshot(frame.limit(0)).collect()
    values = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    for reference, current in ((values, values), (values, values.withColumn("y", F.col("x"))), (values.withColumn("y", F.col("x")), values)):
        with pytest.raises(Exception, match="feature y"):
            mon.population_stability(reference, current, ["x", "y"]).collect()


def _numpy_psi(expected, observed, bins=10, eps=1e-6):
    expected, observed = np.asarray(expected, float), np.asarray(observed, float)
    edges = np.unique(np.quantile(expected, np.linspace(0, 1, bins + 1)))
    if edges.size < 2:
        return 0.0 if np.allclose(expected, observed) else float("inf")
    edges[0], edges[-1] = -np.inf, np.inf
    e = np.clip(np.histogram(expected, edges)[0] / expected.size, eps, None)
    o = np.clip(np.histogram(observed, edges)[0] / observed.size, eps, None)
    return float(np.sum((o - e) * np.log(o / e)))


def _psi(spark, ref, cur):
    r = spark.createDataFrame([(float(x),) for x in ref], "x double")
    c = spark.createDataFrame([(float(x),) for x in cur], "x double")
    return mon.population_stability(r, c, ["x"]).first().psi


def test_psi_thresholds_and_numpy_parity(spark):
    ref = list(range(1, 101))
    assert _psi(spark, ref, [x + 0.05 for x in ref]) < 0.1
    assert _psi(spark, ref, list(range(201, 301))) >= 0.25
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 20, 500), rng.integers(2, 25, 300)
    assert _psi(spark, a, b) == pytest.approx(_numpy_psi(a, b), rel=1e-12)
    c = rng.normal(size=400)
    d = rng.normal(0.3, 1.2, size=250)
    assert _psi(spark, c, d) == pytest.approx(_numpy_psi(c, d), rel=1e-9)
    assert _psi(spark, [3.0] * 10, [3.0] * 5) == 0.0
    assert _psi(spark, [3.0] * 10, [4.0] * 5) == float("inf")


def test_monitoring_report(spark):
    schema = "feature_a double, actual double, prediction double"
    ref = spark.createDataFrame([(i / 10, 10.0, 9.5) for i in range(10)], schema)
    drifted = spark.createDataFrame([(i / 10 + 10, 10.0, 9.5) for i in range(10)], schema)
    worse = spark.createDataFrame([(i / 10, 10.0, 5.0) for i in range(10)], schema)
    r1 = mon.monitoring_report(ref, drifted, feature_names=["feature_a"]).first()
    assert r1.overall_status == "critical" and r1.drift_features == 1 and r1.performance_status == "stable"
    r2 = mon.monitoring_report(ref, worse, feature_names=["feature_a"]).first()
    assert r2.overall_status == "critical" and r2.performance_status == "critical"
    drift = mon.feature_drift_report(ref, drifted, feature_names=["feature_a"]).first()
    assert drift.status == "drift"
    with pytest.raises(ValueError):
        mon.feature_drift_report(ref, drifted, feature_names=["missing"])


def test_conformal_interval(spark):
    frame = scored_df(spark, [10, 12, 14, 16, 18], [9, 11, 16, 15, 20])
    radius = iv.conformal_radius(frame, coverage=0.8).first().radius
    assert radius >= 0
    bounds = frame.withColumns(iv.conformal_bounds("prediction", F.lit(radius))).collect()
    assert all(b.lower >= 0 and b.upper >= b.lower for b in bounds)
    with pytest.raises(ValueError):
        iv.conformal_radius(frame, coverage=1.0)
    rng = np.random.default_rng(1)
    for n, c in ((7, 0.9), (50, 0.8), (123, 0.95), (200, 0.5)):
        a, p = rng.integers(0, 30, n), rng.normal(10, 5, n)
        res = np.abs(a - p)
        level = min(np.ceil((n + 1) * c) / n, 1.0)
        expected = float(np.quantile(res, level, method="higher"))
        got = iv.conformal_radius(scored_df(spark, a, p), coverage=c).first().radius
        assert got == pytest.approx(expected, rel=1e-12)


def test_eda(spark):
    t0, t1 = datetime(2026, 1, 5, 0), datetime(2026, 1, 5, 1)
    frame = demand_df(spark, [(t0, 1, 10), (t0, 2, 0), (t1, 1, 20), (t1, 2, 5)])
    o = eda.demand_overview(frame).first()
    assert (o.rows, o.zones, o.total_demand, o.zero_demand_share) == (4, 2, 35, 0.25)
    hours = eda.hourly_profile(frame).orderBy("hour").collect()
    assert [r.hour for r in hours] == [0, 1] and [r.total_demand for r in hours] == [10, 25]
    assert [r.weekday for r in eda.weekday_profile(frame).collect()] == [1]
    lookup = spark.createDataFrame([(1, "Manhattan", "Alphabet City")], "zone_id smallint, borough string, zone_name string")
    top = eda.top_zones(frame, n=1, zone_lookup=lookup).collect()
    assert top[0].zone_id == 1 and top[0].borough == "Manhattan"
    with pytest.raises(ValueError):
        eda.top_zones(frame, n=0)


def test_zone_lookup_and_one_hots(spark):
    raw = spark.createDataFrame(
        [(1, "EWR", "Newark Airport", "EWR"), (2, "Queens", " Jamaica Bay ", None)], ZONE_LOOKUP_RAW_SCHEMA
    )
    norm = zn.normalize_zone_lookup(raw).orderBy("zone_id").collect()
    assert norm[0].asDict() == {"zone_id": 1, "borough": "EWR", "zone_name": "Newark Airport", "service_zone": "EWR"}
    assert norm[1].zone_name == "Jamaica Bay" and norm[1].service_zone == "Unknown"
    dup = spark.createDataFrame([(1, "a", "b", "c"), (1, "a", "b", "c")], ZONE_LOOKUP_RAW_SCHEMA)
    with pytest.raises(ValueError, match="duplicate"):
        zn.normalize_zone_lookup(dup)
    with pytest.raises(ValueError, match="invalid"):
        zn.normalize_zone_lookup(spark.createDataFrame([(300, "a", "b", "c")], ZONE_LOOKUP_RAW_SCHEMA))
    with pytest.raises(ValueError, match="Missing"):
        zn.normalize_zone_lookup(raw.drop("Zone"))
    features = spark.createDataFrame([(1, 10.0), (2, 20.0), (999, 30.0)], "zone_id int, demand_lag_1h double")
    lookup = spark.createDataFrame([(1, "Manhattan", "Yellow Zone"), (2, "Queens", "Boro Zone")], "zone_id smallint, borough string, service_zone string")
    out = zn.add_zone_features(features, lookup).orderBy("zone_id").collect()
    assert [r.borough_manhattan for r in out] == [1, 0, 0]
    assert [r.borough_queens for r in out] == [0, 1, 0]
    assert [r.borough_unknown for r in out] == [0, 0, 1]
    assert "borough" not in out[0].asDict() and "service_zone" not in out[0].asDict()


def test_kth_smallest_exact_against_numpy(spark):
    from zonecast.functions.selection import kth_smallest

    rng = np.random.default_rng(11)
    values = np.concatenate([rng.normal(0, 1, 3000), np.full(500, 0.25), rng.exponential(5, 1500)])
    frame = spark.createDataFrame([(float(v),) for v in values], "x double")
    ordered = np.sort(values)
    for k in (0, 1, 777, 2500, 3100, len(values) - 1):
        assert kth_smallest(frame, "x", k, buckets=16) == ordered[k]
        assert kth_smallest(frame, "x", k) == ordered[k]
    weighted = spark.createDataFrame([(1.0, 3), (2.0, 1), (5.0, 2)], "x double, c long")
    assert [kth_smallest(weighted, "x", k, weight="c", buckets=2) for k in range(6)] == [1, 1, 1, 2, 5, 5]


def test_approximate_quantile_options_stay_close(spark):
    rng = np.random.default_rng(5)
    a, p = rng.integers(0, 50, 2000), rng.normal(20, 8, 2000)
    frame = scored_df(spark, a, p)
    exact = dg.residual_summary(frame).first()
    approx = dg.residual_summary(frame, approx_accuracy=10000).first()
    assert approx.bias == exact.bias
    assert approx.p90_absolute_error == pytest.approx(exact.p90_absolute_error, rel=0.01)
    snap = mon.performance_snapshot(frame, approx_accuracy=10000).first()
    assert snap.p90_absolute_error == pytest.approx(exact.p90_absolute_error, rel=0.01)
    r = spark.createDataFrame([(float(x),) for x in rng.normal(size=1000)], "x double")
    c = spark.createDataFrame([(float(x),) for x in rng.normal(0.5, 1, 800)], "x double")
    e = mon.population_stability(r, c, ["x"]).first().psi
    ap = mon.population_stability(r, c, ["x"], approx_accuracy=10000).first().psi
    assert ap == pytest.approx(e, rel=0.05)
