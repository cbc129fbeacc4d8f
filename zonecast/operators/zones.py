"""Zone lookup: validation, normalisation and one-hot context features."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.schemas import (
    BOROUGHS, MAX_ZONE_ID, MIN_ZONE_ID, SERVICE_ZONES, ZONE_LOOKUP_COLUMNS, require_columns, safe_name,
)


def zone_lookup_violations(raw: DataFrame) -> DataFrame:
    """One row: ``lookup_rows``, ``duplicate_ids`` (ids present more than
    once), ``invalid_ids`` (rows with a null or out-of-range id)."""
    require_columns(raw, ZONE_LOOKUP_COLUMNS, "taxi-zone")
    per_id = raw.groupBy("LocationID").agg(F.count(F.lit(1)).alias("n"))
    bad = F.col("LocationID").isNull() | ~F.col("LocationID").between(MIN_ZONE_ID, MAX_ZONE_ID)
    return per_id.agg(
        F.sum("n").alias("lookup_rows"),
        F.count_if(F.col("LocationID").isNotNull() & (F.col("n") > 1)).alias("duplicate_ids"),
        F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("invalid_ids"),
    )


def validate_zone_lookup(raw: DataFrame) -> None:
    """Raise on missing columns, an empty lookup, duplicate or invalid ids
    (one small aggregation over the lookup)."""
    row = zone_lookup_violations(raw).first()
    if row is None or not row["lookup_rows"]:
        raise ValueError("Taxi-zone lookup must not be empty")
    if row["duplicate_ids"]:
        raise ValueError("Taxi-zone lookup contains duplicate LocationID values")
    if row["invalid_ids"]:
        raise ValueError("Taxi-zone lookup contains invalid LocationID values")


def normalize_zone_lookup(raw: DataFrame, *, validate: bool = True) -> DataFrame:
    """``zone_id`` SMALLINT, trimmed ``borough``/``zone_name``,
    ``service_zone`` with null -> 'Unknown'."""
    require_columns(raw, ZONE_LOOKUP_COLUMNS, "taxi-zone")
    if validate:
        validate_zone_lookup(raw)
    return raw.select(
        F.col("LocationID").cast("smallint").alias("zone_id"),
        F.trim(F.col("Borough").cast("string")).alias("borough"),
        F.trim(F.col("Zone").cast("string")).alias("zone_name"),
        F.trim(F.coalesce(F.col("service_zone").cast("string"), F.lit("Unknown"))).alias("service_zone"),
    )


def add_zone_features(
    frame: DataFrame,
    zone_lookup: DataFrame,
    *,
    boroughs: Sequence[str] = BOROUGHS,
    service_zones: Sequence[str] = SERVICE_ZONES,
) -> DataFrame:
    """Left-join borough / service zone per ``zone_id`` and add one TINYINT
    indicator per vocabulary entry; missing metadata is 'Unknown', a value
    outside the vocabulary sets no indicator.

    The lookup is reduced to one row per ``zone_id`` (a SMALLINT key, and
    validated lookups hold ids 1..265 only), so broadcasting it is
    size-bounded; the feature frame is never shuffled for this join.
    """
    if "zone_id" not in frame.columns:
        raise ValueError("Feature frame must contain zone_id")
    require_columns(zone_lookup, ("zone_id", "borough", "service_zone"), "zone lookup")
    one_per_zone = zone_lookup.groupBy(F.col("zone_id").cast("smallint").alias("zone_id")).agg(
        F.min(F.struct("borough", "service_zone")).alias("_z")
    ).select("zone_id", F.col("_z.borough").alias("_borough"), F.col("_z.service_zone").alias("_service_zone"))
    joined = frame.join(F.broadcast(one_per_zone), "zone_id", "left")
    borough = F.coalesce(F.col("_borough"), F.lit("Unknown"))
    service = F.coalesce(F.col("_service_zone"), F.lit("Unknown"))
    indicators = {f"borough_{safe_name(b)}": (borough == b).cast("tinyint") for b in boroughs}
    indicators.update({f"service_zone_{safe_name(s)}": (service == s).cast("tinyint") for s in service_zones})
    return joined.withColumns(indicators).drop("_borough", "_service_zone")
