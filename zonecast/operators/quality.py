"""Domain rules for trip rows: per-row flags, clean rows, audit counters."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast import schemas as S
from zonecast.functions.timecols import seconds_between

FLAG_COLUMNS = ("null_pickup", "invalid_zone", "invalid_duration", "invalid_distance")


@dataclass(frozen=True)
class QualityRules:
    min_zone_id: int = S.MIN_ZONE_ID
    max_zone_id: int = S.MAX_ZONE_ID
    min_trip_distance: float = S.MIN_TRIP_DISTANCE
    max_trip_distance: float = S.MAX_TRIP_DISTANCE
    max_trip_duration_hours: float = S.MAX_TRIP_DURATION_HOURS
    required_columns: tuple[str, ...] = S.TRIP_COLUMNS


DEFAULT_RULES = QualityRules()


def flag_expressions(rules: QualityRules = DEFAULT_RULES) -> dict[str, Column]:
    """The four rule predicates. They overlap on purpose: a missing pickup
    also counts as an invalid duration. Every predicate is two-valued
    (null checks are OR-ed in first)."""
    pickup = F.col("tpep_pickup_datetime")
    dropoff = F.col("tpep_dropoff_datetime")
    zone = F.col("PULocationID")
    distance = F.col("trip_distance")
    hours = seconds_between(pickup, dropoff) / F.lit(3600.0)
    null_pickup = pickup.isNull() | dropoff.isNull()
    invalid_zone = zone.isNull() | ~zone.between(rules.min_zone_id, rules.max_zone_id)
    invalid_duration = null_pickup | (hours < 0) | (hours > float(rules.max_trip_duration_hours))
    invalid_distance = distance.isNull() | ~distance.between(
        float(rules.min_trip_distance), float(rules.max_trip_distance)
    )
    return {
        "null_pickup": null_pickup,
        "invalid_zone": invalid_zone,
        "invalid_duration": invalid_duration,
        "invalid_distance": invalid_distance,
    }


def valid_expression(rules: QualityRules = DEFAULT_RULES) -> Column:
    flags = flag_expressions(rules)
    any_flag = flags["null_pickup"] | flags["invalid_zone"] | flags["invalid_duration"] | flags["invalid_distance"]
    return ~any_flag


def quality_flags(trips: DataFrame, rules: QualityRules = DEFAULT_RULES) -> DataFrame:
    """Trips plus one boolean column per rule."""
    S.require_columns(trips, rules.required_columns, "required TLC")
    return trips.withColumns(flag_expressions(rules))


def clean_trips(trips: DataFrame, rules: QualityRules = DEFAULT_RULES) -> DataFrame:
    """Rows that break no rule (a pure filter, fused into the scan stage)."""
    S.require_columns(trips, rules.required_columns, "required TLC")
    return trips.filter(valid_expression(rules))


def quality_report(
    trips: DataFrame,
    rules: QualityRules = DEFAULT_RULES,
    *,
    by: Sequence[str] = (),
) -> DataFrame:
    """Audit counters in one aggregation (per group when ``by`` is given,
    e.g. the source month): input, valid, dropped, the four rule counts and
    the valid share (0.0 for an empty input)."""
    S.require_columns(trips, rules.required_columns, "required TLC")
    flags = flag_expressions(rules)
    counters = [F.count(F.lit(1)).alias("input_rows"), F.count_if(valid_expression(rules)).alias("valid_rows")]
    counters += [F.count_if(flags[name]).alias(f"{name}_rows") for name in FLAG_COLUMNS]
    grouped = trips.groupBy(*by).agg(*counters)
    return grouped.select(
        *by,
        "input_rows",
        "valid_rows",
        (F.col("input_rows") - F.col("valid_rows")).alias("dropped_rows"),
        *[f"{name}_rows" for name in FLAG_COLUMNS],
        F.when(F.col("input_rows") == 0, F.lit(0.0))
        .otherwise(F.col("valid_rows") / F.col("input_rows"))
        .alias("valid_share"),
    )
