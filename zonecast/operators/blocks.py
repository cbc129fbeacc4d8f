"""Windows over time blocks, so that tasks are not limited to the zones.

A window over ``PARTITION BY zone_id`` gives a zone's whole history to one task.
On a complete hourly grid a row only looks at rows a bounded number of hours
away, so a zone's history can be cut into blocks of ``block_hours``: every block
also gets the rows up to ``back`` hours before it and ``ahead`` hours after it
(its halo), windows run within (zone, block), and the halo is dropped
afterwards. Results are the same rows; the shuffle carries
``(back + ahead) / block_hours`` more of them.

This holds on complete grids alone: where hours are missing, "k rows ago" may lie
outside the halo.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.timecols import ntz_literal, seconds_between

BLOCK, HALO = "_block", "_halo"
KEYS = ("zone_id", BLOCK)
HOUR = 3_600


def with_halo(frame: DataFrame, *, block_hours: int, back: int = 0, ahead: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Rows with their block (``_block``), and copies of those near a border
    in the blocks that look at them (``_halo`` true), dealt out by zone and
    block."""
    if block_hours <= 0 or back < 0 or ahead < 0:
        raise ValueError("a block has at least one hour and a halo none at the least")
    hour = F.floor(seconds_between(ntz_literal("1970-01-01 00:00:00"), F.col("timestamp")) / HOUR)
    own = F.floor(hour / block_hours)
    # the blocks that a row is in or near: a run of block numbers
    first, last = F.floor((hour - ahead) / block_hours), F.floor((hour + back) / block_hours)
    copies = frame.withColumn("_own", own).withColumn(BLOCK, F.explode(F.sequence(first, last)))
    marked = copies.withColumn(HALO, F.col(BLOCK) != F.col("_own")).drop("_own")
    # an explicit count keeps adaptive execution from merging CPU-bound tasks by bytes
    width = num_partitions or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return marked.repartition(width, *KEYS)


def without_halo(frame: DataFrame) -> DataFrame:
    return frame.filter(~F.col(HALO)).drop(BLOCK, HALO)
