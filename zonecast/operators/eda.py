"""Exploratory summaries of a demand mart (all single aggregations)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.timecols import iso_weekday
from zonecast.schemas import DEMAND_COLUMNS, require_columns


def _check(frame: DataFrame) -> None:
    require_columns(frame, DEMAND_COLUMNS, "demand")


def demand_overview(frame: DataFrame) -> DataFrame:
    """rows, zones, start, end, total_demand, mean and zero share (one row)."""
    _check(frame)
    return frame.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("zone_id").alias("zones"),
        F.min("timestamp").alias("start"),
        F.max("timestamp").alias("end"),
        F.sum("demand").cast("bigint").alias("total_demand"),
        F.avg("demand").alias("mean_hourly_zone_demand"),
        F.avg((F.col("demand") == 0).cast("double")).alias("zero_demand_share"),
    )


def _profile(frame: DataFrame, key, name: str) -> DataFrame:
    _check(frame)
    return frame.groupBy(key.alias(name)).agg(
        F.sum("demand").cast("bigint").alias("total_demand"),
        F.avg("demand").alias("mean_zone_demand"),
        F.count(F.lit(1)).alias("observations"),
    )


def hourly_profile(frame: DataFrame) -> DataFrame:
    """Demand by hour of day across zones and dates."""
    return _profile(frame, F.hour("timestamp"), "hour")


def weekday_profile(frame: DataFrame) -> DataFrame:
    """Demand by ISO weekday (Monday = 1, Sunday = 7)."""
    return _profile(frame, iso_weekday("timestamp"), "weekday")


def top_zones(frame: DataFrame, *, n: int = 20, zone_lookup: DataFrame | None = None) -> DataFrame:
    """Zones by total demand (ties by ``zone_id``), top ``n``, optionally
    labelled. Plans as a per-partition top-n and one merge
    (TakeOrderedAndProject), never a full sort."""
    _check(frame)
    if n <= 0:
        raise ValueError("n must be positive")
    ranked = (
        frame.groupBy("zone_id")
        .agg(F.sum("demand").cast("bigint").alias("total_demand"), F.avg("demand").alias("mean_hourly_demand"))
        .orderBy(F.desc("total_demand"), F.asc("zone_id"))
        .limit(n)
    )
    if zone_lookup is None:
        return ranked
    require_columns(zone_lookup, ("zone_id", "borough", "zone_name"), "zone lookup")
    # one row per SMALLINT zone id (a validated lookup already is): the
    # broadcast side is bounded by the key domain, whatever the input size
    labels = (
        zone_lookup.groupBy(F.col("zone_id").cast("smallint").alias("zone_id"))
        .agg(F.min(F.struct("borough", "zone_name")).alias("_l"))
        .select("zone_id", "_l.borough", "_l.zone_name")
    )
    return ranked.join(F.broadcast(labels), "zone_id", "left")
