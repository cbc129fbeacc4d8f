"""Reports: one-row tables of aggregated rows, written as JSON.

EDA, benchmark, training, monitoring and explanation. Every input is aggregated
before it is nested (24 hours, 7 weekdays, top-n zones, one row per fold or
feature), so collecting rows into a report is bounded by construction, never by
the data size.
"""
from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.operators import eda
from zonecast.operators.features import build_features
from zonecast.operators.horizons import make_horizon_dataset
from zonecast.operators.monitoring import feature_drift_report, monitoring_report
from zonecast.plans import backtest as bt
from zonecast.plans import models as md
from zonecast.schemas import SEASONAL_PERIOD_HOURS
from zonecast.session import materialize
from zonecast.sources.sinks import write_json_report


def _nested(frame: DataFrame, order: Sequence[str], *, largest_first: str | None = None) -> Column:
    """The (small, aggregated) frame as an array of its rows: by ``order``,
    after ``largest_first`` where that is given."""
    keys = ([(-F.col(largest_first)).alias("_first")] if largest_first else []) + list(order)
    rows = F.sort_array(F.collect_list(F.struct(*keys, *[c for c in frame.columns if c not in order])))
    plain = F.transform(rows, lambda r: F.struct(*[r[c].alias(c) for c in frame.columns]))
    return frame.agg(plain.alias("rows")).scalar()


def _one_row(frame: DataFrame) -> DataFrame:
    """A one-row frame with nothing in it, to select scalars from."""
    return frame.sparkSession.range(1).select()


# ---- EDA ---------------------------------------------------------------------------
def eda_report(frame: DataFrame, *, top_n: int = 20, zone_lookup: DataFrame | None = None) -> DataFrame:
    """Overview + hourly profile + weekday profile + top zones, one row."""
    overview = eda.demand_overview(frame)
    top = eda.top_zones(frame, n=top_n, zone_lookup=zone_lookup)
    return overview.select(
        F.struct(*overview.columns).alias("overview"),
        _nested(eda.hourly_profile(frame), ["hour"]).alias("hourly_profile"),
        _nested(eda.weekday_profile(frame), ["weekday"]).alias("weekday_profile"),
        _nested(top, ["zone_id"], largest_first="total_demand").alias("top_zones"),
    )


def write_eda_report(frame: DataFrame, output_dir: str, **kwargs) -> str:
    return write_json_report(eda_report(frame, **kwargs), os.path.join(output_dir, "eda_report"))


# ---- benchmark -----------------------------------------------------------------------
def benchmark_report(
    features: DataFrame,
    *,
    horizon_hours: int,
    train_days: int,
    validation_days: int,
    step_days: int,
    seasonal_period_hours: int = SEASONAL_PERIOD_HOURS,
    kind: str = "poisson_glm",
    params: dict | None = None,
) -> DataFrame:
    """``horizon_hours``, ``summary`` (means over folds) and ``folds`` of the
    model against the weekly baseline on paired rows. The folds are scored
    once; summary and list read the written fold table."""
    folds = materialize(
        bt.compare_model_to_seasonal_baseline(
            features, horizon_hours=horizon_hours, train_days=train_days, validation_days=validation_days, step_days=step_days,
            seasonal_period_hours=seasonal_period_hours, kind=kind, params=params,
        ),
        name="benchmark-folds",
    )
    summary = bt.summarize_benchmark(folds)
    return summary.select(
        F.lit(int(horizon_hours)).alias("horizon_hours"), F.struct(*summary.columns).alias("summary"), _nested(folds, ["fold"]).alias("folds")
    )


def write_benchmark_report(demand: DataFrame, output_dir: str, **kwargs) -> str:
    """From a mart to the benchmark's JSON."""
    return write_json_report(benchmark_report(build_features(demand), **kwargs), os.path.join(output_dir, "benchmark"))


# ---- training ------------------------------------------------------------------------
def train_and_report(
    demand: DataFrame,
    model_dir: str,
    output_dir: str,
    *,
    horizon_hours: int,
    train_days: int,
    validation_days: int,
    step_days: int,
    kind: str = "poisson_glm",
    params: dict | None = None,
) -> DataFrame:
    """Backtest the model, fit it on all rows, save its bundle and write what
    came of it; returns the report as it was written: ``horizon_hours``,
    ``model_dir``, ``model_version``, ``summary``, ``folds``,
    ``feature_names``."""
    features = materialize(build_features(demand), name="features")
    folds = materialize(
        bt.backtest_model(features, horizon_hours=horizon_hours, train_days=train_days, validation_days=validation_days, step_days=step_days, kind=kind, params=params),
        name="train-folds",
    )
    supervised = make_horizon_dataset(features, horizon_hours=horizon_hours)
    model = md.train_model(supervised, target_column="target_demand", kind=kind, params=params, horizon_hours=horizon_hours)
    model.save(model_dir)
    summary = bt.summarize_folds(folds)
    report = summary.select(
        F.lit(int(horizon_hours)).alias("horizon_hours"),
        F.lit(model_dir).alias("model_dir"),
        F.lit(md.bundle_version(model_dir)).alias("model_version"),
        F.struct(*summary.columns).alias("summary"),
        _nested(folds, ["fold"]).alias("folds"),
        F.array(*[F.lit(f) for f in model.feature_names]).alias("feature_names"),
    )
    return _written(report, os.path.join(output_dir, "training"))


# ---- monitoring ----------------------------------------------------------------------
def monitoring_payload(
    reference: DataFrame,
    current: DataFrame,
    *,
    feature_names: Sequence[str],
    actual_column: str = "actual",
    prediction_column: str = "prediction",
    bins: int = 10,
) -> DataFrame:
    """The monitoring row with the drift of each feature beside it (``drift``,
    largest PSI first)."""
    options = {"feature_names": feature_names, "bins": bins}
    report = monitoring_report(reference, current, actual_column=actual_column, prediction_column=prediction_column, **options)
    drift = feature_drift_report(reference, current, **options)
    return report.withColumn("drift", _nested(drift, ["feature"], largest_first="psi"))


def write_monitoring_report(reference: DataFrame, current: DataFrame, output_dir: str, **kwargs) -> str:
    payload = monitoring_payload(materialize(reference, name="reference"), materialize(current, name="current"), **kwargs)
    return write_json_report(payload, os.path.join(output_dir, "monitoring"))


# ---- explanation ---------------------------------------------------------------------
def explanation_report(model: md.DemandModel, frame: DataFrame, *, top_n: int = 30) -> DataFrame:
    """``horizon_hours``, ``rows_explained`` (all complete rows) and the
    ``top_n`` features by mean absolute contribution."""
    if top_n <= 0:
        raise ValueError("a report names at least one feature")
    rows = md.complete_cases(frame, model.feature_names).agg(F.count(F.lit(1))).scalar()
    top = md.global_contributions(model, frame).limit(top_n)
    return _one_row(frame).select(
        F.lit(model.horizon_hours).alias("horizon_hours"),
        rows.alias("rows_explained"),
        _nested(top, ["feature"], largest_first="mean_abs_contribution").alias("features"),
    )


def write_explanation_report(model_dir: str, frame: DataFrame, output_dir: str, *, top_n: int = 30) -> str:
    """Of the last version of a bundle."""
    report = explanation_report(md.load_model_bundle(model_dir), frame, top_n=top_n)
    return write_json_report(report, os.path.join(output_dir, "explanation"))


def _written(report: DataFrame, path: str) -> DataFrame:
    write_json_report(report, path)
    return report.sparkSession.read.schema(report.schema).json(path)
