"""Realised-performance and drift monitoring.

* ``performance_snapshot`` / ``performance_by_day``: error metrics of a
  scored window (rows with a null actual or prediction are dropped).
* ``feature_drift_report``: quantile-binned PSI for many features at once.
  Both windows are unpivoted to ``(feature, value)``, reduced to distinct
  values with multiplicities and written once; the quantiles of all features
  are selected together in a few passes over that table, and every step after
  that is a grouped aggregation or a join against the per-feature edge table
  (one row per feature, so broadcasting it is bounded by the feature count).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions import metrics as M
from zonecast.functions.status import classify_performance_regression, classify_psi, overall_status, severity_rank
from zonecast.functions.selection import quantile_table
from zonecast.operators.diagnostics import _sketch, absolute_error_quantiles, residual_distribution, snapshot_from_distribution, with_quantiles
from zonecast.schemas import require_columns
from zonecast.session import materialize

EPSILON = 1e-6


def performance_snapshot(
    frame: DataFrame,
    *,
    actual_column: str = "actual",
    prediction_column: str = "prediction",
    by: Sequence[str] = (),
    approx_accuracy: int | None = None,
) -> DataFrame:
    """observations + MAE, RMSE, WAPE, sMAPE, bias, p90 absolute error
    (exact; ``approx_accuracy`` takes p90 from a bounded sketch)."""
    require_columns(frame, {actual_column, prediction_column}, "performance")
    clean = frame.filter(F.col(actual_column).isNotNull() & F.col(prediction_column).isNotNull())
    dist = residual_distribution(clean, actual_column=actual_column, prediction_column=prediction_column, by=by)
    if approx_accuracy:
        quantiles = _sketch(clean, F.abs(M.residual(actual_column, prediction_column)), [0.9], by, approx_accuracy)
    else:
        dist = materialize(dist, name="residuals")
        quantiles = absolute_error_quantiles(dist, [0.9], by)
    snap = snapshot_from_distribution(dist, by)
    none = F.raise_error(F.lit("no row has both an actual and a prediction")).cast("bigint")
    snap = snap.withColumn("observations", F.when(F.coalesce("observations", F.lit(0)) == 0, none).otherwise(F.col("observations")))
    return with_quantiles(snap, quantiles, by, ["p90_absolute_error"])


def performance_by_day(
    frame: DataFrame,
    *,
    timestamp_column: str = "timestamp",
    actual_column: str = "actual",
    prediction_column: str = "prediction",
) -> DataFrame:
    """Per calendar date: observations, mae, bias, wape (+inf on a day with
    zero total demand)."""
    require_columns(frame, {timestamp_column, actual_column, prediction_column}, "daily-performance")
    clean = frame.filter(
        F.col(timestamp_column).isNotNull() & F.col(actual_column).isNotNull() & F.col(prediction_column).isNotNull()
    )
    r = M.residual(actual_column, prediction_column)
    abs_actual = F.sum(F.abs(F.col(actual_column).cast("double")))
    return clean.groupBy(F.to_date(timestamp_column).alias("date")).agg(
        F.count(F.lit(1)).alias("observations"),
        F.avg(F.abs(r)).alias("mae"),
        F.avg(r).alias("bias"),
        M.safe_ratio(F.sum(F.abs(r)), abs_actual, F.lit(M.INF)).alias("wape"),
    )


def _long(frame: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value) for non-null values of every monitored feature."""
    typed = frame.select(*[F.col(f).cast("double").alias(f) for f in features])
    long = typed.unpivot([], list(features), "feature", "value")
    return long.filter(F.col("value").isNotNull())


def _quantile_edges(dist: DataFrame, tagged: DataFrame, steps: Sequence[float], approx_accuracy: int | None) -> DataFrame:
    """``feature, edges``: the distinct reference quantiles, ascending."""
    if approx_accuracy:
        sketch = _sketch(tagged.filter(F.col("_ref")), F.col("value"), steps, ["feature"], approx_accuracy)
        return sketch.select("feature", F.array_sort(F.array_distinct("quantiles")).alias("edges"))
    reference = dist.filter(F.col("_ref") & M.is_finite(F.col("value")))
    found = quantile_table(reference, "value", steps, by=["feature"], weight="c")
    return dist.sparkSession.createDataFrame([(g[0], sorted(set(q))) for g, q in found.items()], "feature string, edges array<double>")


def population_stability(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    *,
    bins: int = 10,
    epsilon: float = EPSILON,
    approx_accuracy: int | None = None,
) -> DataFrame:
    """``feature, psi`` for every feature.

    The reference quantiles are exact, whatever the number of distinct values;
    ``approx_accuracy`` takes them from Spark's mergeable ``percentile_approx``
    sketch instead (one pass, rank error about 1/accuracy).

    Edges are the distinct reference quantiles at 0, 1/bins, ..., 1 (linear
    interpolation), the outer two widened to -inf/+inf; bin of x = number
    of inner edges <= x (bins are [a, b)). Shares are clipped at
    ``epsilon``. A feature with a constant reference has PSI 0 when every
    current value is close to that constant, else +inf.
    """
    if bins < 2:
        raise ValueError(f"a drift histogram has two bins or more, not {bins}")
    if epsilon <= 0:
        raise ValueError(f"the share floor lies above zero, not at {epsilon}")
    if not features:
        raise ValueError("no feature to monitor")
    for f in features:
        if f not in reference.columns or f not in current.columns:
            raise ValueError(f"feature {f} is not in both windows")

    # (feature, side, value) -> multiplicity: one aggregation for both windows
    tagged = _long(reference, features).withColumn("_ref", F.lit(True)).unionByName(
        _long(current, features).withColumn("_ref", F.lit(False))
    )
    dist = materialize(tagged.groupBy("feature", "_ref", "value").agg(F.count(F.lit(1)).alias("c")), name="drift")
    ref_c = F.when(F.col("_ref"), F.col("c"))
    cur_c = F.when(~F.col("_ref"), F.col("c"))
    steps = [i / bins for i in range(bins + 1)]
    bad = ~M.is_finite(F.col("value"))
    # one row per monitored feature on either side of the join
    counts = dist.groupBy("feature").agg(F.sum(ref_c).alias("n_ref"), F.sum(cur_c).alias("n_cur"), F.count_if(bad).alias("bad"))
    counts = counts.join(F.broadcast(_quantile_edges(dist, tagged, steps, approx_accuracy)), "feature", "left")
    edges = counts.withColumn("edges", F.coalesce("edges", F.array().cast("array<double>")))
    inner = F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    constant = F.size("edges") < 2
    lo = F.get("edges", F.lit(0))
    close = F.abs(F.col("value") - lo) <= F.lit(M.ALLCLOSE_ATOL) + F.lit(M.ALLCLOSE_RTOL) * F.abs(lo)
    # the edge table has one row per monitored feature: broadcast is feature-bounded
    joined = dist.join(F.broadcast(edges), "feature")
    binned = joined.groupBy("feature", F.when(constant, F.lit(0)).otherwise(F.size(F.filter(inner, lambda e: e <= F.col("value")))).alias("bin")).agg(
        F.coalesce(F.sum(ref_c), F.lit(0)).alias("c_ref"),
        F.coalesce(F.sum(cur_c), F.lit(0)).alias("c_cur"),
        F.first("n_ref").alias("n_ref"),
        F.first("n_cur").alias("n_cur"),
        F.first(constant).alias("_constant"),
        F.bool_and(F.when(constant & ~F.col("_ref"), close).otherwise(F.lit(True))).alias("_close"),
        F.max("bad").alias("_bad"),
    )
    e = F.greatest(F.col("c_ref") / F.col("n_ref"), F.lit(epsilon))
    o = F.greatest(F.col("c_cur") / F.col("n_cur"), F.lit(epsilon))
    per_feature = binned.groupBy("feature").agg(
        F.sum((o - e) * F.ln(o / e)).alias("_psi"),
        F.first("_constant").alias("_constant"),
        F.bool_and("_close").alias("_close"),
        F.max("_bad").alias("_bad"),
        F.min("n_cur").alias("_n_cur"),
        F.min("n_ref").alias("_n_ref"),
    )
    # one row per feature that was asked for, also when it has no value at all
    asked = reference.sparkSession.createDataFrame([(f,) for f in dict.fromkeys(features)], "feature string")
    per_feature = asked.join(per_feature, "feature", "left")
    guard = F.when(F.col("_bad") > 0, F.raise_error(F.lit("drift compares finite values only")))
    empty = F.when((F.coalesce("_n_cur", F.lit(0)) == 0) | (F.coalesce("_n_ref", F.lit(0)) == 0), F.raise_error(F.concat(F.lit("no values to compare for feature "), F.col("feature"))))
    psi = F.when(F.col("_constant"), F.when(F.col("_close"), F.lit(0.0)).otherwise(F.lit(M.INF))).otherwise(F.col("_psi"))
    return per_feature.select("feature", F.coalesce(guard.cast("double"), empty.cast("double"), psi).alias("psi"))


def feature_drift_report(
    reference: DataFrame,
    current: DataFrame,
    *,
    feature_names: Sequence[str],
    bins: int = 10,
    approx_accuracy: int | None = None,
) -> DataFrame:
    """``feature, psi, status`` ordered by PSI, largest first."""
    psi = population_stability(reference, current, feature_names, bins=bins, approx_accuracy=approx_accuracy)
    return psi.withColumn("status", classify_psi("psi")).orderBy(F.desc("psi"), F.asc("feature"))


def monitoring_report(
    reference: DataFrame,
    current: DataFrame,
    *,
    feature_names: Sequence[str],
    actual_column: str = "actual",
    prediction_column: str = "prediction",
    bins: int = 10,
) -> DataFrame:
    """One row: overall and performance status, both windows' snapshot
    metrics, the worst PSI and counts of drifting / watched features.

    Both windows are tagged and scored in one grouped aggregation."""
    tagged = reference.withColumn("_window", F.lit("reference")).unionByName(
        current.withColumn("_window", F.lit("current")), allowMissingColumns=True
    )
    snap = performance_snapshot(tagged, actual_column=actual_column, prediction_column=prediction_column, by=["_window"])
    metrics = ["observations", "mae", "rmse", "wape", "smape", "bias", "p90_absolute_error"]
    drift = feature_drift_report(reference, current, feature_names=feature_names, bins=bins)
    # two snapshot rows + one row per feature, folded by one conditional
    # aggregation: every input is planned once (no scalar subquery copies,
    # no join between the one-row results)
    parts = snap.select("_window", *metrics).unionByName(
        drift.select("psi", "status").withColumn("_window", F.lit(None).cast("string")), allowMissingColumns=True
    )
    picked = [
        F.max(F.when(F.col("_window") == w, F.col(m))).alias(f"{w}_{m}") for w in ("reference", "current") for m in metrics
    ]
    folded = parts.agg(
        *picked,
        F.max("psi").alias("max_psi"),
        F.count_if(F.col("status") == "drift").alias("drift_features"),
        F.count_if(F.col("status") == "watch").alias("watch_features"),
        F.max(severity_rank("status")).alias("_worst"),
    )
    worst = F.when(F.col("_worst") == 2, "drift").when(F.col("_worst") == 1, "watch").otherwise("stable")
    perf = classify_performance_regression("reference_wape", "current_wape")
    return folded.select(
        overall_status(perf, worst).alias("overall_status"),
        perf.alias("performance_status"),
        *[f"{w}_{m}" for w in ("reference", "current") for m in metrics],
        "max_psi",
        "drift_features",
        "watch_features",
    )
