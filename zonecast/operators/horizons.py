"""Direct-horizon targets and seasonal baselines (same per-zone window).

With ``block_hours`` (complete grids only, see ``blocks.py``) a zone's history is
worked on in blocks of so many hours instead of in one task."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.timecols import add_hours
from zonecast.operators.blocks import KEYS, with_halo, without_halo
from zonecast.operators.features import ZONE, zone_window
from zonecast.schemas import DEMAND_COLUMNS, SEASONAL_PERIOD_HOURS, require_columns


def _check_hours(**hours: int) -> None:
    for name, value in hours.items():
        if value <= 0:
            raise ValueError(f"{name} counts hours from 1 on, not {value}")


def _looked_up(frame: DataFrame, offsets: dict[str, int], block_hours: int | None) -> DataFrame:
    """Adds demand so many rows ahead (negative: before) in the zone."""
    if block_hours:
        back, ahead = max(0, -min(offsets.values())), max(0, max(offsets.values()))
        frame = with_halo(frame, block_hours=block_hours, back=back, ahead=ahead)
    w = zone_window(KEYS if block_hours else ZONE)
    found = frame.withColumns({name: F.lead("demand", k).over(w) if k >= 0 else F.lag("demand", -k).over(w) for name, k in offsets.items()})
    return without_halo(found) if block_hours else found


def _known(frame: DataFrame, columns: Iterable[str]) -> DataFrame:
    for c in columns:
        frame = frame.filter(F.col(c).isNotNull())
    return frame


def make_horizon_dataset(
    frame: DataFrame, *, horizon_hours: int, target_column: str = "target_demand", block_hours: int | None = None
) -> DataFrame:
    """``target = demand`` ``h`` rows ahead in the zone, ``forecast_timestamp
    = timestamp + h``; rows without a target are dropped."""
    _check_hours(horizon_hours=horizon_hours)
    require_columns(frame, DEMAND_COLUMNS, "required")
    ahead = _looked_up(frame, {target_column: horizon_hours}, block_hours)
    return _known(ahead.withColumn("forecast_timestamp", add_hours("timestamp", horizon_hours)), [target_column])


def seasonal_naive(
    frame: DataFrame, *, period_hours: int = SEASONAL_PERIOD_HOURS, prediction_column: str = "prediction", block_hours: int | None = None
) -> DataFrame:
    """Prediction = demand one season earlier (double, null when unknown)."""
    _check_hours(period_hours=period_hours)
    require_columns(frame, DEMAND_COLUMNS, "demand")
    before = _looked_up(frame, {prediction_column: -period_hours}, block_hours)
    return before.withColumn(prediction_column, F.col(prediction_column).cast("double"))


def attach_direct_seasonal_baseline(
    frame: DataFrame,
    *,
    horizon_hours: int,
    seasonal_period_hours: int = SEASONAL_PERIOD_HOURS,
    target_column: str = "target_demand",
    prediction_column: str = "prediction",
    block_hours: int | None = None,
) -> DataFrame:
    """Target ``h`` ahead and the value one season before the *target*
    (``season - h`` rows before the origin), both known at origin time; rows
    missing either are dropped."""
    _check_hours(horizon_hours=horizon_hours)
    if seasonal_period_hours <= horizon_hours:
        raise ValueError(f"a season of {seasonal_period_hours} h gives no baseline {horizon_hours} h ahead")
    require_columns(frame, DEMAND_COLUMNS, "demand")
    both = _looked_up(frame, {target_column: horizon_hours, prediction_column: horizon_hours - seasonal_period_hours}, block_hours)
    typed = both.withColumns({prediction_column: F.col(prediction_column).cast("double"), "forecast_timestamp": add_hours("timestamp", horizon_hours)})
    return _known(typed, [target_column, prediction_column])
