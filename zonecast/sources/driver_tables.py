"""Views of the driver-generated tables as trips and zone lookups.

The driver tables have no trip columns, so one deterministic mapping turns
every ``events`` row into a trip row (no row is dropped). A few rows are
made invalid on purpose so every quality rule fires; the same mapping is
written in DuckDB SQL for the oracle, next to the DataFrame version.

``nation`` joined to ``region`` becomes the zone lookup: zone id =
nation key + 1, borough = region name, zone name = nation name.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.timecols import add_seconds

# Fixed values of the mapping (shared by the DataFrame and the SQL text).
NULL_PICKUP_EVERY = 97          # event_id multiple -> pickup missing
SHIFTED_DROPOFF_EVERY = 101     # event_id multiple -> dropoff 12 h before pickup
ZONE_MULTIPLIER, ZONE_MODULUS = 7, 270        # pickup zone 1..270 (>265 invalid)
DROPOFF_MULTIPLIER, DROPOFF_MODULUS = 11, 265
DISTANCE_MODULUS = 211          # distance 0..210 miles (>200 invalid)
SECONDS_PER_VALUE = 120         # trip length = floor(value * 120) seconds
DRIVER_BOROUGHS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "Unknown")
DRIVER_SERVICE_ZONES = ("Boro Zone", "Yellow Zone", "Airports", "Unknown")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def trips_from_events(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    pickup = F.when(eid % NULL_PICKUP_EVERY != 0, F.col("ts"))
    dropoff = add_seconds("ts", F.floor(F.col("value") * SECONDS_PER_VALUE))
    dropoff = F.when(eid % SHIFTED_DROPOFF_EVERY == 0, F.timestamp_add("HOUR", F.lit(-12), dropoff)).otherwise(dropoff)
    return events.select(
        pickup.alias("tpep_pickup_datetime"),
        dropoff.alias("tpep_dropoff_datetime"),
        ((F.col("user_id") * ZONE_MULTIPLIER) % ZONE_MODULUS + 1).cast("int").alias("PULocationID"),
        ((F.col("user_id") * DROPOFF_MULTIPLIER) % DROPOFF_MODULUS + 1).cast("int").alias("DOLocationID"),
        (eid % DISTANCE_MODULUS).cast("double").alias("trip_distance"),
        F.col("value").alias("total_amount"),
    )


def trips(spark: SparkSession, sf_dir: str, start_time=None, end_time=None) -> DataFrame:
    """The trip view; with a pickup window, the same bounds are first put on
    ``events.ts`` so they reach the Parquet scan (pickup is either ``ts`` or
    missing, and a missing pickup is outside every window, so the result is
    exactly the pickup window of the full view)."""
    events = table(spark, sf_dir, "events")
    if start_time is None and end_time is None:
        return trips_from_events(events)
    from zonecast.sources.trips import pickup_window

    scanned = pickup_window(events, start_time, end_time, column="ts")
    return pickup_window(trips_from_events(scanned), start_time, end_time)


def zone_lookup_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    service = (
        F.when(key % 4 == 0, F.lit("Boro Zone"))
        .when(key % 4 == 1, F.lit("Yellow Zone"))
        .when(key % 4 == 2, F.lit("Airports"))
    )
    # region is a handful of rows: broadcast is size-bounded by construction
    joined = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left")
    return joined.select(
        (key + 1).cast("int").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("Zone"),
        service.alias("service_zone"),
    )


# --- the same views as DuckDB SQL (used only by the oracle) -----------------
TRIPS_SQL = f"""
SELECT
  CASE WHEN event_id % {NULL_PICKUP_EVERY} <> 0 THEN ts END AS tpep_pickup_datetime,
  ts + to_seconds(CAST(floor(value * {SECONDS_PER_VALUE}) AS BIGINT))
     - CASE WHEN event_id % {SHIFTED_DROPOFF_EVERY} = 0 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END
     AS tpep_dropoff_datetime,
  CAST((user_id * {ZONE_MULTIPLIER}) % {ZONE_MODULUS} + 1 AS INTEGER) AS PULocationID,
  CAST((user_id * {DROPOFF_MULTIPLIER}) % {DROPOFF_MODULUS} + 1 AS INTEGER) AS DOLocationID,
  CAST(event_id % {DISTANCE_MODULUS} AS DOUBLE) AS trip_distance,
  value AS total_amount
FROM events
"""

ZONE_LOOKUP_RAW_SQL = """
SELECT
  CAST(n_nationkey + 1 AS INTEGER) AS LocationID,
  r_name AS Borough,
  ' ' || n_name || ' ' AS Zone,
  CASE n_nationkey % 4 WHEN 0 THEN 'Boro Zone' WHEN 1 THEN 'Yellow Zone' WHEN 2 THEN 'Airports' END AS service_zone
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
"""
