"""Deterministic evenly spaced sample of a frame in (timestamp, zone) order."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.session import materialize


def even_sample(
    frame: DataFrame, max_rows: int, *, order=("timestamp", "zone_id"), materialize_input: bool = True
) -> DataFrame:
    """The rows at positions ``trunc(j * ((n - 1) / (m - 1)))`` for
    ``j = 0 .. m-2`` plus the last row (NumPy ``linspace(0, n-1, m,
    dtype=int)`` in the same double arithmetic); all rows when ``n <= m``.

    The global position is built without moving every row to one task:
    rows are counted per ``order[0]`` value (one row per hour), a running
    sum over that small table gives each hour's offset, and a row number
    within the hour completes the index. The ``m`` target positions form a
    table bounded by the sampling parameter. Join strategies are left to
    adaptive execution, which sees the real sizes.
    """
    if max_rows <= 0:
        raise ValueError("max_rows must be positive")
    spark = frame.sparkSession
    if materialize_input:  # read three times below: compute it once
        frame = materialize(frame)
    first, rest = order[0], list(order[1:])
    per_key = frame.groupBy(first).agg(F.count(F.lit(1)).alias("_k"))
    # a window over one row per distinct ordering key (hours), not per row
    offsets = per_key.select(
        first,
        F.coalesce(F.sum("_k").over(Window.orderBy(first).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
    )
    n = per_key.agg(F.sum("_k")).scalar()
    within = Window.partitionBy(first).orderBy(*(rest or [first]))
    indexed = frame.join(offsets, first).withColumn("_i", F.col("_off") + F.row_number().over(within) - 1)
    m = int(max_rows)
    if m == 1:
        targets = spark.range(1).select(F.lit(0).cast("bigint").alias("_i"))
    else:
        # step < 1 when n <= m: the positions then cover every row
        step = (n - 1).cast("double") / F.lit(float(m - 1))
        j = F.col("id")
        pos = F.when(j == m - 1, n - 1).otherwise(F.floor(j.cast("double") * step))
        targets = spark.range(m).select(pos.cast("bigint").alias("_i"))
    return indexed.join(targets.distinct(), "_i", "left_semi").drop("_off", "_i")
