"""Split-conformal symmetric intervals from absolute residuals."""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions import metrics as M
from zonecast.functions.selection import group_sizes, select_ranks
from zonecast.session import materialize


def conformal_radius(
    frame: DataFrame,
    *,
    actual_column: str = "actual",
    prediction_column: str = "prediction",
    coverage: float = 0.9,
    by: Sequence[str] = (),
) -> DataFrame:
    """``coverage, radius`` (per group when ``by`` is given).

    radius = the absolute residual at zero-based rank
    ``ceil(level * (n - 1))`` with ``level = min(ceil((n + 1) * coverage) /
    n, 1)`` (NumPy ``method='higher'``), found exactly without sorting
    rows: residuals are reduced to distinct values with multiplicities
    (map-side combine), written, and the ranks of all groups are selected
    together (:func:`zonecast.functions.selection.select_ranks`), so no
    task ever holds a group's residuals. Non-finite inputs raise, as does
    an empty frame without groups.
    """
    if not 0.0 < coverage < 1.0:
        raise ValueError(f"coverage is a share between zero and one, not {coverage}")
    a = F.col(actual_column).cast("double")
    p = F.col(prediction_column).cast("double")
    dist = materialize(
        frame.groupBy(*by, F.abs(a - p).alias("e")).agg(F.count(F.lit(1)).alias("c"), M.non_finite_count(a, p).alias("bad")),
        name="calibration",
    )
    if dist.filter(F.col("bad") > 0).limit(1).count():
        raise ValueError("calibration needs finite actuals and predictions")
    sizes = group_sizes(dist, F.col("e"), by, F.col("c"))
    if not by and not sizes:
        raise ValueError("calibration needs rows")
    ranks = {g: [conformal_rank(n, coverage)] for g, (n, _, _) in sizes.items()}
    found = select_ranks(dist, "e", ranks, by=by, weight="c", sizes=sizes)
    kinds = {f.name: f.dataType.simpleString() for f in dist.schema.fields}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in by], "coverage double", "radius double"])
    rows = [(*g, float(coverage), values[ranks[g][0]]) for g, values in found.items()]
    return frame.sparkSession.createDataFrame(rows, schema)


def conformal_rank(n: int, coverage: float) -> int:
    """Zero-based rank of NumPy ``quantile(level, method='higher')`` with
    ``level = min(ceil((n + 1) * coverage) / n, 1)`` (same double math)."""
    level = min(math.ceil((n + 1) * coverage) / n, 1.0)
    return int(math.ceil(level * (n - 1)))


def conformal_bounds(prediction: str | Column, radius: str | Column) -> dict[str, Column]:
    """``lower = max(p - r, 0)``, ``upper = p + r``; non-finite predictions raise."""
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    r = F.col(radius) if isinstance(radius, str) else radius
    checked = F.when(~M.is_finite(p), F.raise_error(F.lit("an interval needs a finite prediction")).cast("double")).otherwise(p)
    return {"lower": F.greatest(checked - r, F.lit(0.0)), "upper": checked + r}
