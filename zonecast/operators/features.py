"""History-only features per zone: calendar, lags, shifted rolling stats.

All lag and rolling columns share one window specification
(``PARTITION BY zone_id ORDER BY timestamp``), so Spark plans them into
window operators over a single sort of a single partitioning; when the
input comes from :func:`zonecast.operators.mart.complete_hourly_grid` that
partitioning is already in place and no exchange is added.

Rolling means/stds of an integral series are computed from running sums
(sum, sum of squares, count) and two offset lookups per window, i.e. O(1)
per row for any window length; a sliding ROWS frame would rescan the whole
frame for every row (O(window) per row). Integer sums are exact, so the
mean is the correctly rounded ratio and the sample variance is
``(n*sum(x^2) - sum(x)^2) / (n*(n-1))`` with an exact numerator.
Non-integral inputs fall back to frame aggregates.
"""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.timecols import calendar_columns
from zonecast.operators.blocks import KEYS, with_halo, without_halo
from zonecast.schemas import DEFAULT_LAGS, DEFAULT_WINDOWS, DEMAND_COLUMNS, require_columns


ZONE = ("zone_id",)


def zone_window(keys: Sequence[str] = ZONE, ts: str = "timestamp"):
    return Window.partitionBy(*keys).orderBy(ts)


def add_calendar_features(frame: DataFrame, ts: str = "timestamp") -> DataFrame:
    return frame.withColumns(calendar_columns(ts))


def lag_columns(lags: Iterable[int] = DEFAULT_LAGS, value: str = "demand", keys: Sequence[str] = ZONE) -> dict:
    w = zone_window(keys)
    return {f"{value}_lag_{k}h": F.lag(value, k).over(w) for k in lags}


def add_lag_features(frame: DataFrame, lags: Iterable[int] = DEFAULT_LAGS, value: str = "demand") -> DataFrame:
    """Positional lag per zone (equals "k hours ago" on a complete grid)."""
    return frame.withColumns(lag_columns(lags, value))


def _is_integral(frame: DataFrame, value: str) -> bool:
    return isinstance(frame.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _rolling_columns(
    frame: DataFrame, windows: tuple[int, ...], value: str, first_step: dict | None = None, keys: Sequence[str] = ZONE
) -> DataFrame:
    """Three projections: (1) running totals (plus any other columns of the
    same window spec, e.g. lags and calendar), (2) the running totals at
    offsets 1 and w + 1, each its own column so every window expression
    occurs once, (3) mean / std arithmetic, dropping the helpers."""
    w = zone_window(keys)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = F.col(value).cast("bigint")
    totals = {"_rs": F.sum(F.coalesce(x, F.lit(0))), "_rq": F.sum(F.coalesce(x * x, F.lit(0))), "_rn": F.count(x)}
    step1 = {**(first_step or {}), **{name: agg.over(running) for name, agg in totals.items()}}
    staged = frame.select("*", *[c.alias(n) for n, c in step1.items()])
    offsets = sorted({1, *[size + 1 for size in windows]})
    lagged = {f"{name}_{k}": F.coalesce(F.lag(name, k).over(w), F.lit(0)) for name in totals for k in offsets}
    staged = staged.select("*", *[c.alias(n) for n, c in lagged.items()])
    cols = []
    for size in windows:
        n = F.col("_rn_1") - F.col(f"_rn_{size + 1}")
        s_ = F.col("_rs_1") - F.col(f"_rs_{size + 1}")
        q = F.col("_rq_1") - F.col(f"_rq_{size + 1}")
        variance = (n * q - s_ * s_).cast("double") / (n * (n - 1)).cast("double")
        cols.append(F.when(n >= 1, s_.cast("double") / n.cast("double")).alias(f"{value}_roll_mean_{size}h"))
        cols.append(F.when(n >= 2, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias(f"{value}_roll_std_{size}h"))
    keep = [c for c in staged.columns if c not in totals and c not in lagged]
    return staged.select(*keep, *cols)


def add_rolling_features(
    frame: DataFrame, windows: Iterable[int] = DEFAULT_WINDOWS, value: str = "demand", keys: Sequence[str] = ZONE
) -> DataFrame:
    """Mean (>= 1 value) and sample std (>= 2 values) of the previous
    ``w`` rows of each zone, the current row excluded."""
    windows = tuple(windows)
    if not _is_integral(frame, value):
        w = zone_window(keys)
        cols = {}
        for size in windows:
            frame_w = w.rowsBetween(-size, -1)
            cols[f"{value}_roll_mean_{size}h"] = F.avg(value).over(frame_w)
            cols[f"{value}_roll_std_{size}h"] = F.stddev_samp(value).over(frame_w)
        return frame.withColumns(cols)
    return _rolling_columns(frame, windows, value, keys=keys)


def build_features(
    demand: DataFrame,
    *,
    lags: Iterable[int] = DEFAULT_LAGS,
    windows: Iterable[int] = DEFAULT_WINDOWS,
    block_hours: int | None = None,
) -> DataFrame:
    """Mart + 5 calendar + lag + rolling mean/std columns, no sort at the
    end (order only at a sink).

    With ``block_hours`` (complete grids only, see ``blocks.py``) a zone's
    history is worked on in blocks of so many hours, so there are as many
    tasks as zones times blocks."""
    require_columns(demand, DEMAND_COLUMNS, "demand")
    lags, windows = tuple(lags), tuple(windows)
    if block_hours:
        blocked = with_halo(demand, block_hours=block_hours, back=max((*lags, *windows), default=0))
        return without_halo(_featured(blocked, lags, windows, KEYS))
    return _featured(demand, lags, windows, ZONE)


def _featured(demand: DataFrame, lags: tuple[int, ...], windows: tuple[int, ...], keys: Sequence[str]) -> DataFrame:
    first = {**calendar_columns("timestamp"), **lag_columns(lags, keys=keys)}
    if windows and _is_integral(demand, "demand"):
        return _rolling_columns(demand, windows, "demand", first_step=first, keys=keys)
    featured = demand.select("*", *[c.alias(n) for n, c in first.items()])
    return add_rolling_features(featured, windows, keys=keys) if windows else featured
