"""Hourly demand mart: counts per (hour, zone) and the zero-filled grid.

Scale notes
-----------
* The raw trip scan is the only input that grows with the fleet; it is
  reduced by a partial (map-side) hash aggregation to at most one row per
  (hour, zone) per task before any shuffle, so a hot zone cannot skew the
  exchange (which is keyed by hour *and* zone).
* The counts (mart-sized, independent of trip volume) are checkpointed
  once, so the raw scan runs exactly once per build.
* The grid is generated, not joined: each observed zone explodes the hourly
  ``sequence`` between global bounds obtained by a scalar subquery over the
  checkpointed counts. There is no cartesian join.
* Grid rows and counts are unioned and summed after one repartition on
  ``zone_id``. That partitioning satisfies both the (timestamp, zone_id)
  aggregation and any later per-zone window, so the feature windows reuse
  it (no second shuffle of the mart). Every zone holds exactly one row per
  hour, so the partitions are balanced.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.timecols import hour_floor
from zonecast.operators.quality import DEFAULT_RULES, QualityRules, clean_trips
from zonecast.schemas import DEMAND_COLUMNS, require_columns
from zonecast.session import materialize


def hourly_counts(
    clean: DataFrame,
    *,
    timestamp_column: str = "tpep_pickup_datetime",
    zone_column: str = "PULocationID",
) -> DataFrame:
    """``timestamp`` (hour, NTZ), ``zone_id`` SMALLINT, ``demand`` INT."""
    return (
        clean.select(
            hour_floor(timestamp_column).alias("timestamp"),
            F.col(zone_column).cast("smallint").alias("zone_id"),
        )
        .groupBy("timestamp", "zone_id")
        .agg(F.count(F.lit(1)).cast("int").alias("demand"))
    )


def complete_hourly_grid(
    counts: DataFrame, *, num_partitions: int | None = None, materialize_counts: bool = True
) -> DataFrame:
    """Every observed zone x every hour between the first and last observed
    hour, demand 0 where nothing was counted.

    The counts feed three branches (bounds, zone set, union). They are
    checkpointed once first: otherwise Catalyst rewrites the bounds and the
    zone set into separate aggregations of the raw scan (min/max and
    distinct are insensitive to the grouping below them), i.e. extra full
    scans of the trip data.
    """
    require_columns(counts, DEMAND_COLUMNS, "demand")
    if materialize_counts:
        counts = materialize(counts.select(*DEMAND_COLUMNS), name="hourly_counts")
        # cheap on the written table: no bounds exist without a counted row,
        # and the zone count caps the useful width of the per-zone shuffle
        zone_count = counts.agg(F.count_distinct("zone_id")).first()[0]
        if not zone_count:
            raise ValueError("No valid trip rows remain after quality checks")
    else:
        zone_count = None
    bounds = counts.agg(F.struct(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))).scalar()
    zones = counts.select("zone_id").distinct()
    hours = F.sequence(bounds.getField("lo"), bounds.getField("hi"), F.expr("INTERVAL 1 HOUR"))
    grid = zones.select(F.explode(hours).alias("timestamp"), "zone_id", F.lit(0).alias("demand"))
    both = grid.unionByName(counts.select(*DEMAND_COLUMNS))
    # An explicit count keeps AQE from coalescing this shuffle by bytes: the
    # per-zone windows that run on it are CPU-bound, not I/O-bound. More
    # partitions than zones would stay empty.
    n = num_partitions or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if zone_count and not num_partitions:
        n = max(1, min(n, zone_count))
    both = both.repartition(n, "zone_id")
    return both.groupBy("timestamp", "zone_id").agg(F.sum("demand").cast("int").alias("demand"))


def aggregate_hourly_demand(
    trips: DataFrame,
    rules: QualityRules = DEFAULT_RULES,
    *,
    complete_grid: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """Clean trips -> hourly counts -> (optionally) complete grid.

    ``complete_grid=False`` keeps only observed (hour, zone) rows; lags on
    such a mart mean "k observed rows ago", as documented upstream.
    """
    counts = hourly_counts(clean_trips(trips, rules))
    return complete_hourly_grid(counts, num_partitions=num_partitions) if complete_grid else counts


def merge_hourly_demand(marts: DataFrame | Sequence[DataFrame], *, num_partitions: int | None = None) -> DataFrame:
    """Merge partial marts (e.g. one per month or per source): sum demand
    of duplicate keys and re-grid over all zones and hours.

    Partial grids only add zero rows, which change neither the sums nor
    the bounds nor the zone set, so summing the union of the inputs and
    gridding once is the same as merging gridded inputs.
    """
    frames = [marts] if isinstance(marts, DataFrame) else list(marts)
    if not frames:
        raise ValueError("At least one monthly demand frame is required")
    for index, frame in enumerate(frames):
        missing = sorted(set(DEMAND_COLUMNS).difference(frame.columns))
        if missing:
            raise ValueError(f"Monthly demand frame {index} is missing columns: {', '.join(missing)}")
    union = frames[0].select(*DEMAND_COLUMNS)
    for frame in frames[1:]:
        union = union.unionByName(frame.select(*DEMAND_COLUMNS))
    typed = union.select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.col("zone_id").cast("smallint").alias("zone_id"),
        F.col("demand").cast("int").alias("demand"),
    )
    # the grid step already sums duplicate keys, so one aggregation suffices
    return complete_hourly_grid(typed, num_partitions=num_partitions)
