"""One-job fold evaluation vs a per-fold loop of filters (the reference's
shape), computed in pandas/NumPy on the smallest driver data."""
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest

from zonecast.operators import horizons as hz
from zonecast.operators import mart as mt
from zonecast.plans import backtest as bt
from zonecast.sources import driver_tables as dt

SF = "/root/testdata/sf0.001"


def _folds(ts: pd.Series, train, val, step):
    start, end = ts.min(), ts.max()
    vs, out, f = start + timedelta(days=train), [], 1
    while vs + timedelta(days=val) <= end + timedelta(hours=1):
        out.append((f, start, vs, vs + timedelta(days=val)))
        vs += timedelta(days=step)
        f += 1
    return out


def _metrics(a, p):
    e = np.abs(a - p)
    den = np.abs(a) + np.abs(p)
    smape = np.mean(np.divide(2 * e, den, out=np.zeros_like(e), where=den != 0))
    wape = e.sum() / np.abs(a).sum() if np.abs(a).sum() else (0.0 if np.allclose(a, p) else np.inf)
    return e.mean(), np.sqrt(np.mean((a - p) ** 2)), wape, smape


@pytest.mark.parametrize("h,train,val,step", [(6, 14, 4, 4), (24, 10, 3, 2), (1, 12, 5, 5)])
def test_baseline_backtest_equals_per_fold_loop(spark, h, train, val, step):
    mart = mt.aggregate_hourly_demand(dt.trips(spark, SF))
    sup = hz.attach_direct_seasonal_baseline(mart, horizon_hours=h).toPandas()
    got = {r.fold: r for r in bt.backtest_seasonal_baseline(
        mart, horizon_hours=h, train_days=train, validation_days=val, step_days=step).collect()}
    expected = {}
    for f, start, vs, ve in _folds(sup["timestamp"], train, val, step):
        tr = sup[(sup.timestamp >= start) & (sup.timestamp < vs)]
        va = sup[(sup.timestamp >= vs) & (sup.timestamp < ve) & (sup.forecast_timestamp < ve)]
        if len(tr) and len(va):
            expected[f] = (len(tr), len(va), *_metrics(va.target_demand.to_numpy(float), va.prediction.to_numpy(float)))
    assert set(got) == set(expected) and expected
    for f, (ntr, nva, mae, rmse, wape, smape) in expected.items():
        r = got[f]
        assert (r.train_rows, r.validation_rows) == (ntr, nva)
        assert [r.mae, r.rmse, r.wape, r.smape] == pytest.approx([mae, rmse, wape, smape], rel=1e-12)


def test_guarded_train_counts_equal_filters(spark):
    mart = mt.aggregate_hourly_demand(dt.trips(spark, SF))
    sup_df = hz.make_horizon_dataset(mart, horizon_hours=24)
    from zonecast.operators.folds import plan_expanding_folds

    plan = plan_expanding_folds(sup_df, train_days=9, validation_days=3, step_days=2)
    got = {r.fold: r.train_rows for r in plan.train_counts(sup_df, label_guard=True).collect()}
    sup = sup_df.toPandas()
    for f, start, vs, _ in _folds(sup["timestamp"], 9, 3, 2):
        n = ((sup.timestamp >= start) & (sup.timestamp < vs) & (sup.forecast_timestamp < vs)).sum()
        assert got.get(f, 0) == n
