"""All folds together against one Spark ML fit per fold."""
import json
import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.operators.folds import plan_expanding_folds
from zonecast.plans import backtest as bt
from zonecast.plans import fold_glm as fg
from zonecast.plans import models as md

FEATURES = ("zone_id", "hour", "month", "demand_lag_1h", "noise")


@pytest.fixture(scope="module")
def supervised(spark):
    rng = np.random.default_rng(17)
    rows = []
    for i in range(24 * 12):
        t = datetime(2024, 5, 26) + timedelta(hours=i)
        for zone in (3, 90, 240):
            lag = float(rng.poisson(6 + zone / 40))
            rate = math.exp(0.4 + 0.001 * zone + 0.35 * math.log1p(lag) + 0.02 * t.hour)
            rows.append((t, t + timedelta(hours=6), zone, t.hour, t.month, lag if i % 37 else None, float(rng.normal()), int(rng.poisson(rate))))
    frame = spark.createDataFrame(rows, "timestamp timestamp_ntz, forecast_timestamp timestamp_ntz, zone_id int, hour int, month int, demand_lag_1h double, noise double, target_demand int")
    return frame.repartition(5).cache()


@pytest.fixture(scope="module")
def plan(supervised):
    return plan_expanding_folds(supervised, train_days=4, validation_days=3, step_days=2)


def fitted(supervised, plan, penalties, **options):
    clean = md.complete_cases(supervised, [*FEATURES, "target_demand"])
    blocks = fg.design_blocks(clean, [md.design_column(f) for f in FEATURES], "target_demand", plan.first_training_fold())
    return fg.fit_folds(blocks, len(FEATURES), range(1, plan.count + 1), penalties, **options)


def test_coefficients_equal_the_fit_of_each_fold(supervised, plan):
    penalties = [0.0, 1e-4, 0.5]
    found = fitted(supervised, plan, penalties, tol=1e-10)
    assert plan.count == 3 and len(found) == 9 and all(m.converged for m in found.values())
    for fold in (1, 3):
        for p, penalty in enumerate(penalties):
            one = md.train_model(bt._fold_train(supervised, plan, fold), feature_columns=FEATURES, target_column="target_demand", params={"regParam": penalty, "tol": 1e-10})
            intercept, coefficients = one.coefficients
            assert found[fold, p].intercept == pytest.approx(intercept, abs=1e-6)
            assert found[fold, p].coefficients == pytest.approx(coefficients, abs=1e-6)
    # fold 1 ends within May: month does not vary there
    assert found[1, 0].coefficients[2] == 0.0 and found[3, 0].coefficients[2] != 0.0


def test_predictions_equal_the_fit_of_each_fold(supervised, plan):
    got = bt.score_folds(supervised, plan, FEATURES, keep_columns=("timestamp", "zone_id"))
    rows = {(r.fold, r.timestamp, r.zone_id): r.model_prediction for r in got.collect()}
    validation = md.complete_cases(plan.validation_rows(supervised), [*FEATURES, "target_demand"])
    assert len(rows) == validation.count()
    model = md.train_model(bt._fold_train(supervised, plan, 2), feature_columns=FEATURES, target_column="target_demand")
    for r in model.predict(validation.filter("fold = 2")).collect():
        assert rows[2, r.timestamp, r.zone_id] == pytest.approx(r.prediction, rel=1e-5)


def test_jobs_do_not_grow_with_folds_and_penalties(supervised, plan, monkeypatch):
    passes = []
    real = fg.summed
    monkeypatch.setattr(fg, "summed", lambda blocks, work: passes.append(1) or real(blocks, work))
    few = fitted(supervised, plan, [1e-4])
    one, passes[:] = len(passes), []
    many = fitted(supervised, plan, [1e-6, 1e-5, 1e-4, 1e-3])
    assert len(passes) <= one + 2 and len(many) == 4 * len(few)
    assert many[2, 2].coefficients == pytest.approx(few[2, 0].coefficients, abs=1e-9)


def test_iterations_are_bounded(supervised, plan):
    found = fitted(supervised, plan, [1e-4, 1e-4], max_iter=[1, 50])
    assert not found[1, 0].converged and found[1, 0].iterations == 2 and found[1, 1].converged


def test_no_training_rows(supervised, plan):
    assert fitted(supervised.filter("timestamp > TIMESTAMP_NTZ '2024-06-30'"), plan, [0.0]) == {}
    late = supervised.withColumn("noise", F.when(F.col("timestamp") > datetime(2024, 6, 1), F.col("noise")))
    with pytest.raises(ValueError, match="fold 1"):
        bt.score_folds(late, plan, FEATURES)
    with pytest.raises(ValueError, match="learning"):
        bt.score_folds(supervised, plan, FEATURES, params={"learning": 1})


def demand_of(supervised):
    return supervised.withColumnRenamed("target_demand", "demand").drop("forecast_timestamp")


OPTIONS = {"horizon_hours": 6, "train_days": 4, "validation_days": 3, "step_days": 2}


def test_search_scores_every_trial_on_every_fold(supervised):
    frame = demand_of(supervised)
    found = bt.search_parameters(frame, n_trials=3, generations=1, keep=1, **OPTIONS).collect()
    assert sorted(r.trial for r in found) == [1, 2, 3] and [r.wape for r in found] == sorted(r.wape for r in found)
    assert {r.folds for r in found} == {3}
    worst = found[-1]
    alone = bt.summarize_folds(bt.backtest_model(frame, params=json.loads(worst.params), **OPTIONS)).first()
    assert worst.wape == pytest.approx(alone.wape, rel=1e-6)


@pytest.mark.parametrize("kind, n", [("poisson_glm", 9), ("poisson_trees", 3)])
def test_halving_fits_fewer_folds_for_the_same_best(supervised, monkeypatch, kind, n):
    if kind == "poisson_trees":
        monkeypatch.setitem(bt.SEARCH_SPACE, kind, {**bt.SEARCH_SPACE[kind], "rounds": ("int", 2, 4), "max_depth": ("int", 1, 3)})
    frame = demand_of(supervised)
    full = bt.search_parameters(frame, n_trials=n, generations=1, keep=1, kind=kind, **OPTIONS).collect()
    halved = bt.search_parameters(frame, n_trials=n, generations=1, keep=3, kind=kind, **OPTIONS).collect()
    assert sum(r.folds for r in halved) < sum(r.folds for r in full) == 3 * n
    assert halved[0].folds == 3 and halved[0].wape == pytest.approx(full[0].wape, rel=1e-3)
    again = bt.search_parameters(frame, n_trials=n, generations=1, keep=3, kind=kind, **OPTIONS).collect()
    assert again == halved


def test_later_trials_lie_around_the_best():
    space = bt.SEARCH_SPACE["poisson_trees"]
    first = bt.parameter_trials(40, kind="poisson_trees", seed=1)
    assert len(space) == 9 and first == bt.parameter_trials(40, kind="poisson_trees", seed=1) != bt.parameter_trials(40, kind="poisson_trees", seed=2)
    assert all(space[k][1] <= t[k] <= space[k][2] for t in first for k in space)
    error = lambda t: abs(math.log(t["learning_rate"] / 0.05))
    later = bt.parameter_trials(40, kind="poisson_trees", seed=1, results=[(error(t), t) for t in first])
    assert np.mean([error(t) for t in later]) < 0.6 * np.mean([error(t) for t in first])
    assert all(space[k][1] <= t[k] <= space[k][2] for t in later for k in space)
    with pytest.raises(ValueError):
        bt.parameter_trials(0)
