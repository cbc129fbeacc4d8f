"""Forecast-error aggregate builders.

Each builder returns aggregate ``Column``s that can be used in any
``groupBy(...).agg(...)`` (global, per fold, per zone, per day), so every
metric table is one partial + final hash aggregation.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonecast.schemas import ALLCLOSE_ATOL, ALLCLOSE_RTOL

INF = float("inf")


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(INF))


def residual(actual: str | Column, prediction: str | Column) -> Column:
    return _col(actual).cast("double") - _col(prediction).cast("double")


def safe_ratio(numerator: Column, denominator: Column, when_zero: Column) -> Column:
    """``numerator / denominator`` with an explicit value for a zero
    denominator (ANSI division by zero raises)."""
    return F.when(denominator == 0, when_zero).otherwise(numerator / denominator)


def mae(actual, prediction) -> Column:
    return F.avg(F.abs(residual(actual, prediction)))


def rmse(actual, prediction) -> Column:
    e = residual(actual, prediction)
    return F.sqrt(F.avg(e * e))


def wape(actual, prediction) -> Column:
    """sum|a-p| / sum|a|; on zero total demand 0.0 if all predictions are
    close to the actuals (np.allclose tolerances), else +inf."""
    a = _col(actual).cast("double")
    p = _col(prediction).cast("double")
    denominator = F.sum(F.abs(a))
    close = F.bool_and(F.abs(a - p) <= F.lit(ALLCLOSE_ATOL) + F.lit(ALLCLOSE_RTOL) * F.abs(p))
    zero_case = F.when(close, F.lit(0.0)).otherwise(F.lit(INF))
    return safe_ratio(F.sum(F.abs(a - p)), denominator, zero_case)


def smape(actual, prediction) -> Column:
    """Mean of 2|a-p|/(|a|+|p|), a term is 0 when both are 0 (range 0..2)."""
    a = _col(actual).cast("double")
    p = _col(prediction).cast("double")
    denominator = F.abs(a) + F.abs(p)
    term = F.when(denominator == 0, F.lit(0.0)).otherwise(F.lit(2.0) * F.abs(a - p) / denominator)
    return F.avg(term)


def bias(actual, prediction) -> Column:
    return F.avg(residual(actual, prediction))


def forecast_metrics(actual="actual", prediction="prediction", prefix: str = "") -> list[Column]:
    """MAE, RMSE, WAPE and sMAPE as one list of aggregate columns. A row with
    a null, NaN or infinite side makes the group an error: leaving it out
    would change the metric silently."""
    bad = non_finite_count(actual, prediction) > 0
    refused = F.raise_error(F.lit("forecast metrics need finite actuals and predictions")).cast("double")
    return [
        F.when(bad, refused).otherwise(metric(actual, prediction)).alias(f"{prefix}{metric.__name__}")
        for metric in (mae, rmse, wape, smape)
    ]


def non_finite_count(*columns: str | Column) -> Column:
    """Aggregate counting rows where any of the columns is null, NaN or inf."""
    bad = None
    for c in columns:
        cond = ~is_finite(_col(c).cast("double"))
        bad = cond if bad is None else (bad | cond)
    return F.count_if(bad)


def improvement(model: str | Column, baseline: str | Column) -> Column:
    """1 - model/baseline, 0.0 when the baseline error is 0."""
    m = _col(model)
    b = _col(baseline)
    return F.when(b == 0, F.lit(0.0)).otherwise(F.lit(1.0) - m / b)


def demand_band(actual: str | Column) -> Column:
    """zero / low (<=5) / medium (<=20) / high."""
    a = _col(actual)
    return (
        F.when(a == 0, F.lit("zero"))
        .when(a <= 5, F.lit("low"))
        .when(a <= 20, F.lit("medium"))
        .otherwise(F.lit("high"))
    )


def demand_band_order(band: str | Column) -> Column:
    b = _col(band)
    return (
        F.when(b == "zero", F.lit(0))
        .when(b == "low", F.lit(1))
        .when(b == "medium", F.lit(2))
        .otherwise(F.lit(3))
    )
