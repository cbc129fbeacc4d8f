from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import demand_df, hourly_series
from zonecast.operators import features as feat
from zonecast.operators import folds as fo
from zonecast.operators import horizons as hz
from zonecast.plans import backtest as bt

D0 = datetime(2024, 1, 1)


def test_lag_and_rolling(spark):
    frame = hourly_series(spark, D0, [10, 20, 30], zone=1)
    out = feat.build_features(frame, lags=(1,), windows=(2,)).orderBy("timestamp").collect()
    assert [r.demand_lag_1h for r in out] == [None, 10, 20]
    assert [r.demand_roll_mean_2h for r in out] == [None, 10.0, 15.0]
    assert [r.hour for r in out] == [0, 1, 2]
    assert out[2].demand_roll_std_2h == pytest.approx(7.0710678118654755)
    assert out[1].demand_roll_std_2h is None


def test_lags_do_not_cross_zones(spark):
    frame = demand_df(spark, [(D0, 1, 10), (D0, 2, 100), (D0 + timedelta(hours=1), 1, 20), (D0 + timedelta(hours=1), 2, 200)])
    out = feat.add_lag_features(frame, lags=(1,))
    for zone, expected in ((1, [None, 10]), (2, [None, 100])):
        got = [r.demand_lag_1h for r in out.filter(F.col("zone_id") == zone).orderBy("timestamp").collect()]
        assert got == expected


def test_running_sum_rolling_matches_frame_aggregates(spark):
    import random

    rng = random.Random(7)
    values = [rng.randint(0, 50) for _ in range(400)]
    frame = hourly_series(spark, D0, values, zone=3)
    fast = feat.add_rolling_features(frame, windows=(3, 24, 168))
    slow = feat.add_rolling_features(frame.withColumn("demand", F.col("demand").cast("double")), windows=(3, 24, 168))
    a = {r.timestamp: r for r in fast.collect()}
    for r in slow.collect():
        for w in (3, 24, 168):
            for stat in ("mean", "std"):
                x, y = getattr(a[r.timestamp], f"demand_roll_{stat}_{w}h"), getattr(r, f"demand_roll_{stat}_{w}h")
                assert (x is None and y is None) or x == pytest.approx(y, rel=1e-12, abs=1e-12)


def test_features_are_history_only(spark):
    """Changing demand at or after an origin never changes its features."""
    values = [(i * 7) % 13 for i in range(300)]
    origin = D0 + timedelta(hours=200)
    base = feat.build_features(hourly_series(spark, D0, values))
    changed = [v if i < 200 else v + 1000 for i, v in enumerate(values)]
    other = feat.build_features(hourly_series(spark, D0, changed))
    cols = [c for c in base.columns if c != "demand"]
    a = base.filter(F.col("timestamp") == origin).select(cols).collect()
    b = other.filter(F.col("timestamp") == origin).select(cols).collect()
    assert a == b


def test_horizon_targets(spark):
    frame = hourly_series(spark, datetime(2026, 1, 1), [10, 11, 12, 13, 14])
    out = hz.make_horizon_dataset(frame, horizon_hours=2).orderBy("timestamp").collect()
    assert [r.target_demand for r in out] == [12, 13, 14]
    assert all(r.forecast_timestamp == r.timestamp + timedelta(hours=2) for r in out)
    with pytest.raises(ValueError):
        hz.make_horizon_dataset(frame, horizon_hours=0)


def test_seasonal_naive(spark):
    frame = hourly_series(spark, D0, [5, 6, 7, 8], zone=1)
    out = hz.seasonal_naive(frame, period_hours=2).orderBy("timestamp").collect()
    assert [r.prediction for r in out] == [None, None, 5.0, 6.0]


def _weekly(spark, hours=672):
    values = [20 + i % 24 + 3 * ((i // 24) % 7) for i in range(hours)]
    return hourly_series(spark, datetime(2026, 1, 1), values), values


def test_direct_baseline_uses_value_one_season_before_target(spark):
    frame, values = _weekly(spark)
    out = hz.attach_direct_seasonal_baseline(frame, horizon_hours=24).orderBy("timestamp").collect()
    start = datetime(2026, 1, 1)
    for r in out[:50]:
        target_index = int((r.timestamp - start).total_seconds() // 3600) + 24
        assert r.prediction == float(values[target_index - 168])
    with pytest.raises(ValueError):
        hz.attach_direct_seasonal_baseline(frame, horizon_hours=168)


def test_baseline_backtest_folds(spark):
    frame, _ = _weekly(spark)
    folds = bt.backtest_seasonal_baseline(frame, horizon_hours=6, train_days=10, validation_days=4, step_days=4)
    rows = folds.collect()
    assert len(rows) >= 2
    assert all(r.validation_rows > 0 and r.train_rows > 0 for r in rows)
    # weekly pattern is exact: the weekly baseline is perfect
    assert all(r.mae == 0.0 and r.wape == 0.0 for r in rows)
    summary = bt.summarize_folds(folds).first()
    assert summary.mae == 0.0


def test_expanding_folds_count_and_order(spark):
    frame = hourly_series(spark, D0, [1] * 960, zone=1)
    folds = fo.expanding_window_folds(frame, train_days=20, validation_days=5, step_days=5).orderBy("fold").collect()
    assert len(folds) == 4
    assert all(f.train_end <= f.validation_start for f in folds)
    plan = fo.plan_expanding_folds(frame, train_days=20, validation_days=5, step_days=5)
    supervised = frame.withColumn("forecast_timestamp", F.col("timestamp"))
    tagged = plan.validation_rows(supervised, label_guard=False)
    counts = {r.fold: r.c for r in tagged.groupBy("fold").agg(F.count("*").alias("c")).collect()}
    assert counts == {1: 120, 2: 120, 3: 120, 4: 120}
    trains = {r.fold: r.train_rows for r in plan.train_counts(supervised, label_guard=False).collect()}
    assert trains == {1: 480, 2: 600, 3: 720, 4: 840}
    assert fo.plan_expanding_folds(frame, train_days=40, validation_days=5, step_days=5).count == 0
    with pytest.raises(ValueError):
        fo.plan_expanding_folds(frame, train_days=0, validation_days=5, step_days=5)


def test_overlapping_folds_membership(spark):
    """step < validation: a row belongs to several folds, same as filters."""
    frame = hourly_series(spark, D0, list(range(24 * 20)), zone=1)
    sup = hz.make_horizon_dataset(frame, horizon_hours=3)
    plan = fo.plan_expanding_folds(sup, train_days=5, validation_days=3, step_days=1)
    tagged = {(r.fold, r.timestamp) for r in plan.validation_rows(sup).select("fold", "timestamp").collect()}
    expected = set()
    for f, _, _, vs, ve in plan.boundaries():
        for r in sup.collect():
            if vs <= r.timestamp < ve and r.forecast_timestamp < ve:
                expected.add((f, r.timestamp))
    assert tagged == expected


# ---- time blocks -------------------------------------------------------------
def grid_of(spark, hours=700, zones=(1, 7, 200)):
    import random

    rng = random.Random(3)
    return demand_df(spark, [(D0 + timedelta(hours=h), z, rng.randint(0, 40)) for h in range(hours) for z in zones])


@pytest.mark.parametrize("block_hours", [1, 24, 100, 5000])
def test_blocks_give_the_same_features(spark, block_hours):
    frame = grid_of(spark)
    options = {"lags": (1, 24, 168), "windows": (3, 72)}
    rows = lambda f: sorted(tuple(r) for r in f.collect())
    want = feat.build_features(frame, **options)
    got = feat.build_features(frame, block_hours=block_hours, **options)
    assert got.columns == want.columns and repr(rows(got)) == repr(rows(want))
    doubles = frame.withColumn("demand", F.col("demand").cast("double"))
    got, want = feat.build_features(doubles, block_hours=block_hours, **options), feat.build_features(doubles, **options)
    for a, b in zip(rows(got), rows(want)):
        assert a[:10] == b[:10] and all(x == pytest.approx(y) for x, y in zip(a[10:], b[10:]))


def test_blocks_give_the_same_targets(spark):
    frame = grid_of(spark)
    rows = lambda f: sorted(tuple(r) for r in f.collect())
    for build, options in (
        (hz.make_horizon_dataset, {"horizon_hours": 24}), (hz.seasonal_naive, {}), (hz.attach_direct_seasonal_baseline, {"horizon_hours": 6}),
    ):
        want, got = build(frame, **options), build(frame, block_hours=48, **options)
        assert got.columns == want.columns and rows(got) == rows(want)


def test_blocks_give_more_tasks_than_zones(spark):
    out = feat.build_features(grid_of(spark, zones=(5,)), block_hours=24)
    assert out.withColumn("p", F.spark_partition_id()).select("p").distinct().count() > 4
    with pytest.raises(ValueError):
        feat.build_features(grid_of(spark), block_hours=-1)
