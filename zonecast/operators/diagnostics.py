"""Residual diagnostics: error rows, summaries, per-zone and per-band tables."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions import metrics as M
from zonecast.functions.selection import quantile_frame
from zonecast.schemas import require_columns
from zonecast.session import materialize


def error_frame(frame: DataFrame, *, actual_column: str = "target_demand", prediction_column: str = "prediction") -> DataFrame:
    """Adds ``residual = actual - prediction`` and ``absolute_error``."""
    require_columns(frame, {"timestamp", "zone_id", actual_column, prediction_column}, "diagnostic")
    r = M.residual(actual_column, prediction_column)
    return frame.withColumns({"residual": r, "absolute_error": F.abs(r)})


def residual_distribution(
    frame: DataFrame, *, actual_column: str = "actual", prediction_column: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Residuals reduced to one row per distinct value (per group), with
    every additive statistic the error reports need: multiplicity ``n``,
    ``abs_actual`` (sum |a|), ``smape_sum``, ``all_close`` (np.allclose
    test) and ``bad`` (rows with a null/NaN/inf input).

    The aggregation combines map-side, so count residuals (integers) shrink
    to a handful of rows before the shuffle.
    """
    a = F.col(actual_column).cast("double")
    p = F.col(prediction_column).cast("double")
    r = a - p
    den = F.abs(a) + F.abs(p)
    return frame.groupBy(*by, r.alias("r")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.abs(a)).alias("abs_actual"),
        F.sum(F.when(den == 0, F.lit(0.0)).otherwise(F.lit(2.0) * F.abs(r) / den)).alias("smape_sum"),
        F.bool_and(F.abs(r) <= F.lit(M.ALLCLOSE_ATOL) + F.lit(M.ALLCLOSE_RTOL) * F.abs(p)).alias("all_close"),
        M.non_finite_count(a, p).alias("bad"),
    )


def _finite_guard(message: str) -> Column:
    return F.when(F.sum("bad") > 0, F.raise_error(F.lit(message)))


def residual_summary(
    frame: DataFrame,
    *,
    actual_column: str = "actual",
    prediction_column: str = "prediction",
    by: Sequence[str] = (),
    approx_accuracy: int | None = None,
) -> DataFrame:
    """bias, median and p90 absolute error (linear interpolation, exact),
    under/over-prediction shares; non-finite inputs raise.

    The quantiles of all groups are selected together in a few passes over the
    written residual distribution, see ``functions/selection.py``. With
    ``approx_accuracy`` they come from a mergeable ``percentile_approx`` sketch
    over the rows instead (one pass, bounded memory per group)."""
    dist = residual_distribution(frame, actual_column=actual_column, prediction_column=prediction_column, by=by)
    columns = {"median_absolute_error": 0.5, "p90_absolute_error": 0.9}
    if approx_accuracy:
        residuals = F.abs(M.residual(actual_column, prediction_column))
        quantiles = _sketch(frame, residuals, list(columns.values()), by, approx_accuracy)
    else:
        dist = materialize(dist, name="residuals")
        quantiles = absolute_error_quantiles(dist, list(columns.values()), by)
    total = F.sum("n").cast("double")
    unknown = F.lit(None).cast("double")
    main = dist.groupBy(*by).agg(
        F.coalesce(_finite_guard("residuals need finite actuals and predictions").cast("double"),
                   F.sum(F.col("r") * F.col("n")) / total).alias("bias"),
        *[unknown.alias(c) for c in columns],
        (F.sum(F.when(F.col("r") > 0, F.col("n")).otherwise(0)) / total).alias("underprediction_share"),
        (F.sum(F.when(F.col("r") < 0, F.col("n")).otherwise(0)) / total).alias("overprediction_share"),
    )
    return with_quantiles(main, quantiles, by, list(columns))


def absolute_error_quantiles(dist: DataFrame, quantiles: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns and an array ``quantiles`` of the absolute residuals of a
    residual distribution (a written table: it is read in several passes). Rows
    that are not finite are left to the caller's guard."""
    finite = F.when(M.is_finite(F.col("r")), F.abs("r"))
    return quantile_frame(dist, finite, quantiles, by=by, weight="n")


def _sketch(frame: DataFrame, value: Column, quantiles: Sequence[float], by: Sequence[str], accuracy: int) -> DataFrame:
    wanted = F.array(*[F.lit(q) for q in quantiles])
    return frame.groupBy(*by).agg(F.percentile_approx(value, wanted, int(accuracy)).alias("quantiles"))


def with_quantiles(main: DataFrame, quantiles: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Fill the (null) ``columns`` of ``main`` from the array ``quantiles`` of
    the same group. Grouped frames join on their keys, null keys included; two
    one-row results fold into one aggregation (no keyless join)."""
    place = {c: F.get("quantiles", F.lit(i)).alias(c) for i, c in enumerate(columns)}
    if by:
        keyed = quantiles.withColumnsRenamed({c: f"_q_{c}" for c in by})
        same = F.lit(True)
        for c in by:
            same &= F.col(c).eqNullSafe(F.col(f"_q_{c}"))
        joined = main.drop(*columns).join(keyed, same, "left")
        return joined.select(*[place.get(c, F.col(c)) for c in main.columns])
    parts = main.drop(*columns).unionByName(quantiles, allowMissingColumns=True)
    folded = parts.agg(*[F.max(c).alias(c) for c in main.columns if c not in columns], F.max("quantiles").alias("quantiles"))
    return folded.select(*[place.get(c, F.col(c)) for c in main.columns])


def snapshot_from_distribution(dist: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """observations, mae, rmse, wape, smape, bias and a null
    ``p90_absolute_error`` to be filled by ``with_quantiles``."""
    total = F.sum("n")
    abs_err = F.sum(F.abs("r") * F.col("n"))
    abs_act = F.sum("abs_actual")
    zero_case = F.when(F.bool_and("all_close"), F.lit(0.0)).otherwise(F.lit(M.INF))
    return dist.groupBy(*by).agg(
        F.coalesce(_finite_guard("a snapshot needs finite actuals and predictions").cast("bigint"), total).alias("observations"),
        (abs_err / total).alias("mae"),
        F.sqrt(F.sum(F.col("r") * F.col("r") * F.col("n")) / total).alias("rmse"),
        M.safe_ratio(abs_err, abs_act, zero_case).alias("wape"),
        (F.sum("smape_sum") / total).alias("smape"),
        (F.sum(F.col("r") * F.col("n")) / total).alias("bias"),
        F.lit(None).cast("double").alias("p90_absolute_error"),
    )


def zone_error_table(frame: DataFrame, *, actual_column: str = "target_demand", prediction_column: str = "prediction") -> DataFrame:
    """Per zone: mae, bias, actual total, observations; worst MAE first
    (ties by ``zone_id``)."""
    errors = error_frame(frame, actual_column=actual_column, prediction_column=prediction_column)
    return (
        errors.groupBy("zone_id")
        .agg(
            F.avg("absolute_error").alias("mae"),
            F.avg("residual").alias("bias"),
            F.sum(actual_column).alias("actual_demand"),
            F.count(F.lit(1)).alias("observations"),
        )
        .orderBy(F.desc("mae"), F.asc("zone_id"))
    )


def demand_band_error_table(frame: DataFrame, *, actual_column: str = "target_demand", prediction_column: str = "prediction") -> DataFrame:
    """Per demand band (zero, low, medium, high, in that order): mae, bias,
    observations."""
    errors = error_frame(frame, actual_column=actual_column, prediction_column=prediction_column)
    return (
        errors.withColumn("demand_band", M.demand_band(actual_column))
        .groupBy("demand_band")
        .agg(F.avg("absolute_error").alias("mae"), F.avg("residual").alias("bias"), F.count(F.lit(1)).alias("observations"))
        .orderBy(M.demand_band_order("demand_band"))
    )
