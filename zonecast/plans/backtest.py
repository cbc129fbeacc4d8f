"""Backtests: every fold scored in one job.

The supervised frame is tagged with fold numbers by column arithmetic
(:class:`zonecast.operators.folds.FoldPlan`), then a single
``groupBy('fold')`` computes all fold metrics with partial aggregation.
Training-row counts come from an hourly pre-aggregate, so nothing here
grows faster than the supervised frame itself.
"""
from __future__ import annotations

import json
import math
import random
from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions import metrics as M
from zonecast.functions.timecols import ntz_literal
from zonecast.operators.folds import FoldPlan, plan_expanding_folds
from zonecast.operators.horizons import attach_direct_seasonal_baseline, make_horizon_dataset
from zonecast.plans import fold_glm
from zonecast.plans.models import DEFAULT_PARAMS, complete_cases, design_column, input_violation_columns, raise_on_violations, train_model
from zonecast.schemas import SEASONAL_PERIOD_HOURS, infer_feature_columns
from zonecast.session import materialize

METRIC_NAMES = ("mae", "rmse", "wape", "smape")


def fold_metrics(
    supervised: DataFrame,
    plan: FoldPlan,
    *,
    horizon_hours: int,
    train_label_guard: bool,
    actual: str = "target_demand",
    prediction: str = "prediction",
) -> DataFrame:
    """``fold, horizon_hours, train_rows, validation_rows, mae, rmse, wape,
    smape``; folds with no training or no validation row are skipped."""
    validation = plan.validation_rows(supervised, label_guard=True)
    scored = validation.groupBy("fold").agg(
        F.count(F.lit(1)).alias("validation_rows"), *M.forecast_metrics(actual, prediction)
    )
    train = plan.train_counts(supervised, label_guard=train_label_guard)
    # both sides hold at most one row per fold
    joined = scored.join(F.broadcast(train), "fold", "inner")
    return joined.select(
        F.col("fold").cast("int").alias("fold"),
        F.lit(int(horizon_hours)).alias("horizon_hours"),
        "train_rows",
        "validation_rows",
        *METRIC_NAMES,
    )


def backtest_seasonal_baseline(
    frame: DataFrame,
    *,
    horizon_hours: int,
    train_days: int,
    validation_days: int,
    step_days: int,
    seasonal_period_hours: int = SEASONAL_PERIOD_HOURS,
) -> DataFrame:
    """Direct weekly baseline scored on expanding-window folds.

    Like the reference, training rows are counted without the label guard
    (the baseline is not fitted, so this affects ``train_rows`` only)."""
    supervised = attach_direct_seasonal_baseline(
        frame, horizon_hours=horizon_hours, seasonal_period_hours=seasonal_period_hours
    )
    plan = plan_expanding_folds(
        supervised, train_days=train_days, validation_days=validation_days, step_days=step_days
    )
    if plan.count == 0:
        raise ValueError(f"the data end before a fold of {train_days} + {validation_days} days does")
    return fold_metrics(supervised, plan, horizon_hours=horizon_hours, train_label_guard=False)


def summarize_folds(folds: DataFrame, metrics=METRIC_NAMES) -> DataFrame:
    """Unweighted mean over folds (one row)."""
    return folds.agg(*[F.avg(m).alias(m) for m in metrics])


# ---- fitted-model backtests -------------------------------------------------------
def stable(frame: DataFrame) -> DataFrame:
    """Materialise a frame that many jobs reuse (the fold loop) with a
    reliable checkpoint in ``spark.checkpoint.dir``: lineage is cut and a
    lost executor does not force recomputation from the raw scan."""
    return materialize(frame)


def _fold_train(supervised: DataFrame, plan: FoldPlan, fold: int) -> DataFrame:
    vs = ntz_literal(plan.first_validation_start + timedelta(days=plan.step_days * (fold - 1)))
    ts = F.col("timestamp")
    return supervised.filter((ts >= ntz_literal(plan.origin)) & (ts < vs) & (F.col("forecast_timestamp") < vs))


def score_folds(
    supervised: DataFrame,
    plan: FoldPlan,
    feature_columns,
    *,
    kind: str = "poisson_glm",
    params: dict | None = None,
    target_column: str = "target_demand",
    keep_columns=(),
    folds: Sequence[int] | None = None,
) -> DataFrame:
    """Fit one model per fold (all, or those of ``folds``) on its leakage-guarded training rows and
    score its validation rows; returns all scored folds (``fold``, target,
    ``model_prediction``, ``keep_columns``).

    Folds without training or validation rows are skipped (their sizes come
    from one small aggregate over the fold tags). The GLMs of all folds are
    fitted together (``fold_glm``); tree models fold by fold."""
    usable = list(folds) if folds is not None else _usable_folds(supervised, plan)
    if kind == "poisson_glm":
        scored = _score_glm_folds(supervised, plan, usable, feature_columns, [params or {}], target_column, keep_columns)
        return scored.drop("trial")
    validation = plan.validation_rows(supervised, label_guard=True)
    out = None
    for fold in usable:
        model = train_model(
            _fold_train(supervised, plan, fold), feature_columns=feature_columns, target_column=target_column,
            kind=kind, params=params,
        )
        rows = complete_cases(validation.filter(F.col("fold") == fold), [*feature_columns, target_column])
        scored = model.predict(rows, prediction_column="model_prediction").select("fold", target_column, "model_prediction", *keep_columns)
        out = scored if out is None else out.unionByName(scored)
    return out


def _usable_folds(supervised: DataFrame, plan: FoldPlan) -> list[int]:
    validation = plan.validation_rows(supervised, label_guard=True)
    scored = {r["fold"] for r in validation.select("fold").distinct().collect()}
    trained = {r["fold"] for r in plan.train_counts(supervised, label_guard=True).collect() if r["train_rows"]}
    usable = sorted(scored & trained)
    if not usable:
        raise ValueError("no fold has both training and validation rows once their labels must lie inside")
    return usable


def _score_glm_folds(
    supervised: DataFrame,
    plan: FoldPlan,
    folds: Sequence[int],
    feature_columns: Sequence[str],
    trials: Sequence[dict],
    target_column: str,
    keep_columns: Sequence[str] = (),
) -> DataFrame:
    """``trial`` (from 1), ``fold``, target, ``model_prediction`` of every
    trial's parameters on every fold: one fit and one scoring job for all."""
    for params in trials:
        if extra := sorted(set(params) - set(DEFAULT_PARAMS)):
            raise ValueError(f"parameters without a meaning here: {', '.join(extra)}")
    clean = complete_cases(supervised, [*feature_columns, target_column])
    raise_on_violations(clean.agg(*input_violation_columns(feature_columns, target_column)).first().asDict())
    design = [design_column(f) for f in feature_columns]
    first = plan.first_training_fold(label_guard=True)
    inside = (first <= plan.count) & (F.col("timestamp") >= ntz_literal(plan.origin))
    blocks = fold_glm.design_blocks(clean.filter(inside), design, target_column, first)
    values = [{**DEFAULT_PARAMS, **params} for params in trials]
    models = fold_glm.fit_folds(
        blocks, len(design), folds, [v["regParam"] for v in values], max_iter=[v["maxIter"] for v in values], tol=min(v["tol"] for v in values)
    )
    if bare := [f for f in folds if (f, 0) not in models]:
        raise ValueError(f"no complete training row in fold {bare[0]}")
    span = plan.count + 1
    keyed = {t * span + f: m for (f, t), m in models.items()}
    validation = complete_cases(plan.validation_rows(supervised, label_guard=True), [*feature_columns, target_column])
    rows = validation.filter(F.col("fold").isin(list(folds)))
    rows = rows.withColumn("trial", F.explode(F.array(*[F.lit(t + 1) for t in range(len(trials))])))
    prediction = fold_glm.score_column(keyed, design, (F.col("trial") - 1) * span + F.col("fold"))
    return rows.select("trial", "fold", target_column, prediction.alias("model_prediction"), *keep_columns)


def backtest_model(
    feature_frame: DataFrame,
    *,
    horizon_hours: int,
    train_days: int,
    validation_days: int,
    step_days: int,
    kind: str = "poisson_glm",
    params: dict | None = None,
    checkpoint: bool = True,
) -> DataFrame:
    """Expanding-window backtest of a fitted count model: ``fold,
    horizon_hours, train_rows, validation_rows, mae, rmse, wape, smape``.

    ``train_rows`` is counted before incomplete rows are dropped for the
    fit; ``validation_rows`` after."""
    supervised = make_horizon_dataset(feature_frame, horizon_hours=horizon_hours)
    if checkpoint:
        supervised = stable(supervised)
    plan = plan_expanding_folds(supervised, train_days=train_days, validation_days=validation_days, step_days=step_days)
    if plan.count == 0:
        raise ValueError(f"the data end before a fold of {train_days} + {validation_days} days does")
    features = infer_feature_columns(supervised)
    scored = score_folds(supervised, plan, features, kind=kind, params=params)
    metrics = scored.groupBy("fold").agg(
        F.count(F.lit(1)).alias("validation_rows"), *M.forecast_metrics("target_demand", "model_prediction")
    )
    train = plan.train_counts(supervised, label_guard=True)
    return metrics.join(F.broadcast(train), "fold").select(
        F.col("fold").cast("int").alias("fold"), F.lit(int(horizon_hours)).alias("horizon_hours"),
        "train_rows", "validation_rows", *METRIC_NAMES,
    )


def compare_model_to_seasonal_baseline(
    feature_frame: DataFrame,
    *,
    horizon_hours: int,
    train_days: int,
    validation_days: int,
    step_days: int,
    seasonal_period_hours: int = SEASONAL_PERIOD_HOURS,
    kind: str = "poisson_glm",
    params: dict | None = None,
    checkpoint: bool = True,
) -> DataFrame:
    """Paired folds: model and weekly baseline scored on identical rows.

    ``fold, horizon_hours, validation_rows, model_mae, baseline_mae,
    model_wape, baseline_wape, mae_improvement, wape_improvement``."""
    features = infer_feature_columns(make_horizon_dataset(feature_frame, horizon_hours=horizon_hours))
    bench = attach_direct_seasonal_baseline(
        feature_frame, horizon_hours=horizon_hours, seasonal_period_hours=seasonal_period_hours
    )
    bench = complete_cases(bench, [*features, "target_demand", "prediction"])
    if checkpoint:
        bench = stable(bench)
    plan = plan_expanding_folds(bench, train_days=train_days, validation_days=validation_days, step_days=step_days)
    if plan.count == 0:
        raise ValueError(f"the data end before a fold of {train_days} + {validation_days} days does")
    scored = score_folds(bench, plan, features, kind=kind, params=params, keep_columns=("prediction",))
    folds = scored.groupBy("fold").agg(
        F.count(F.lit(1)).alias("validation_rows"),
        M.mae("target_demand", "model_prediction").alias("model_mae"),
        M.mae("target_demand", "prediction").alias("baseline_mae"),
        M.wape("target_demand", "model_prediction").alias("model_wape"),
        M.wape("target_demand", "prediction").alias("baseline_wape"),
    )
    return folds.select(
        F.col("fold").cast("int").alias("fold"), F.lit(int(horizon_hours)).alias("horizon_hours"),
        "validation_rows", "model_mae", "baseline_mae", "model_wape", "baseline_wape",
        M.improvement("model_mae", "baseline_mae").alias("mae_improvement"),
        M.improvement("model_wape", "baseline_wape").alias("wape_improvement"),
    )


BENCHMARK_METRICS = ("model_mae", "baseline_mae", "mae_improvement", "model_wape", "baseline_wape", "wape_improvement")


def summarize_benchmark(folds: DataFrame, *, long: bool = False) -> DataFrame:
    """Unweighted means over folds (mean of per-fold improvements). With
    ``long`` also the (metric, model, baseline, improvement) table."""
    wide = folds.agg(*[F.avg(m).alias(m) for m in BENCHMARK_METRICS])
    if not long:
        return wide
    return wide.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(f"model_{m}").alias("model"),
                             F.col(f"baseline_{m}").alias("baseline"), F.col(f"{m}_improvement").alias("improvement"))
                    for m in ("mae", "wape")
                ]
            )
        ).alias("r")
    ).select("r.*")


#: Ranges that a search draws from: (kind of scale, lowest, highest).
SEARCH_SPACE = {
    "poisson_glm": {"regParam": ("log", 1e-6, 1e-1), "maxIter": ("int", 25, 100)},
    "gbt": {"maxIter": ("int", 20, 120), "maxDepth": ("int", 3, 8), "stepSize": ("log", 1e-2, 0.3), "subsamplingRate": ("linear", 0.65, 1.0)},
    "poisson_trees": {
        "rounds": ("int", 20, 120), "learning_rate": ("log", 0.01, 0.3), "max_leaves": ("int", 8, 64), "max_depth": ("int", 3, 8), "min_rows": ("int", 10, 120),
        "row_share": ("linear", 0.65, 1.0), "feature_share": ("linear", 0.65, 1.0), "l1": ("log", 1e-8, 10.0), "l2": ("log", 1e-8, 10.0),
    },
}
#: A later trial lies around an earlier one, this share of a range away.
NEAR = 0.15


def _draw(rng: random.Random, space: dict, around: dict | None = None) -> dict:
    """One set of parameters: anywhere in the space, or around another."""
    out = {}
    for name, (scale, low, high) in space.items():
        a, b = (math.log(low), math.log(high)) if scale == "log" else (low, high)
        if around is None:
            x = rng.uniform(a, b)
        else:
            centre = math.log(around[name]) if scale == "log" else around[name]
            x = min(b, max(a, rng.gauss(centre, NEAR * (b - a))))
        out[name] = min(high, max(low, math.exp(x))) if scale == "log" else round(x) if scale == "int" else x
    return out


def parameter_trials(n_trials: int, *, seed: int = 42, kind: str = "poisson_glm", results: Sequence[tuple[float, dict]] = ()) -> list[dict]:
    """Seeded parameter sets. Without ``results`` they lie anywhere in the
    space; with results, pairs of (error, parameters), they lie around the best
    quarter of those."""
    if n_trials <= 0:
        raise ValueError("a search needs at least one trial")
    space = SEARCH_SPACE[kind]
    rng = random.Random(f"{seed}/{len(results)}")
    best = [p for _, p in sorted(results, key=lambda r: r[0])[:max(1, len(results) // 4)]]
    trials = [_draw(rng, space, best[i % len(best)] if best else None) for i in range(n_trials)]
    return [{**t, "seed": seed} if kind != "poisson_glm" else t for t in trials]


def fold_errors(supervised: DataFrame, plan: FoldPlan, folds: Sequence[int], feature_columns, trials: Sequence[dict], *, kind: str) -> list[list[float]]:
    """WAPE of each trial on each of ``folds``. The GLMs of all trials and
    folds are fitted together; tree models one by one, their scores are
    aggregated in one job."""
    if kind == "poisson_glm":
        scored = _score_glm_folds(supervised, plan, folds, feature_columns, trials, "target_demand")
    else:
        parts = [
            score_folds(supervised, plan, feature_columns, kind=kind, params=params, folds=folds).withColumn("trial", F.lit(t + 1))
            for t, params in enumerate(trials)
        ]
        scored = reduce(DataFrame.unionByName, parts)
    rows = scored.groupBy("trial", "fold").agg(M.wape("target_demand", "model_prediction").alias("wape")).collect()
    found = {(r["trial"], r["fold"]): r["wape"] for r in rows}
    return [[found[t + 1, f] for f in folds] for t in range(len(trials))]


def search_parameters(
    feature_frame: DataFrame,
    *,
    horizon_hours: int,
    train_days: int,
    validation_days: int,
    step_days: int,
    n_trials: int = 4,
    seed: int = 42,
    kind: str = "poisson_glm",
    generations: int = 2,
    keep: int = 3,
) -> DataFrame:
    """Adaptive search for the smallest mean expanding-window WAPE, best first:
    ``trial, params (JSON), wape, folds, generation``.

    Trials come in ``generations``: the first lies anywhere in the space, later
    ones around the best quarter so far. Within a generation folds are rungs
    (successive halving): all trials meet the first fold, on each further rung,
    of twice as many folds, only the best of ``keep`` go on. ``folds`` tells on
    how many a trial was scored; a trial that met all of them stands before one
    that did not. ``keep=1`` takes every trial to every fold. The supervised
    frame is written once and shared."""
    if n_trials <= 0 or generations <= 0 or keep <= 0:
        raise ValueError("a search needs at least one trial, one generation and one trial to keep")
    supervised = stable(make_horizon_dataset(feature_frame, horizon_hours=horizon_hours))
    plan = plan_expanding_folds(supervised, train_days=train_days, validation_days=validation_days, step_days=step_days)
    if plan.count == 0:
        raise ValueError(f"the data end before a fold of {train_days} + {validation_days} days does")
    features = infer_feature_columns(supervised)
    folds = _usable_folds(supervised, plan)
    told: list[tuple[dict, list[float], int]] = []
    sizes = [n_trials // generations + (g < n_trials % generations) for g in range(generations)]
    for generation, size in enumerate((s for s in sizes if s), start=1):
        # trials that left early are judged by the folds they met
        known = [(sum(errors) / len(errors), params) for params, errors, _ in told]
        trials = parameter_trials(size, seed=seed, kind=kind, results=known)
        errors: list[list[float]] = [[] for _ in trials]
        alive, met = list(range(len(trials))), 0
        while met < len(folds):
            rung = folds[met:] if keep == 1 else folds[met:max(1, 2 * met)]
            for i, more in zip(alive, fold_errors(supervised, plan, rung, features, [trials[i] for i in alive], kind=kind)):
                errors[i] += more
            met += len(rung)
            alive = sorted(alive, key=lambda i: (sum(errors[i]) / len(errors[i]), i))[:max(1, -(-len(alive) // keep))] if keep > 1 else alive
        told += [(params, found, generation) for params, found in zip(trials, errors)]
    rows = [(t, json.dumps(params, sort_keys=True), float(sum(e) / len(e)), len(e), g) for t, (params, e, g) in enumerate(told, start=1)]
    rows.sort(key=lambda r: (-r[3], r[2], r[0]))
    return supervised.sparkSession.createDataFrame(rows, "trial int, params string, wape double, folds int, generation int").coalesce(1)
