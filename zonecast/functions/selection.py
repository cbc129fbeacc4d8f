"""Exact order statistics of many groups without sorting a group in one task.

A table of targets ``(group, rank)`` is narrowed in shared passes. Every pass is
one grouped aggregation over all open targets of all groups: a row of the data
meets the open ranges of its group, falls into one of ``buckets`` equal-width
buckets of each range that holds it, and the buckets' counts, smallest and
largest values come back. The bucket in which a target's rank lies becomes its
new range, bounded by values that occur, so every range shrinks to a single
value. Ranks that end up in the same range share it from then on.

What one pass sends to the driver is at most ``buckets`` rows for each open
range, and there are as many open ranges as distinct targets; neither depends
on the number of rows or distinct values. A hot group is counted in every map
task before anything is shuffled.
"""
from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Group = tuple

#: Buckets of a range in one pass; fewer when many ranges are open.
BUCKETS = 1024
#: Rows that a pass may send to the driver.
PASS_ROWS = 1 << 18


@dataclass(frozen=True)
class Range:
    """Values from ``lo`` to ``hi`` of a group; ``below`` rows lie under it."""

    group: Group
    lo: float
    hi: float
    below: int

    def step(self, buckets: int) -> tuple[float, float]:
        """Width of a bucket and the scale it is measured in: ranges wider
        than the largest double are halved first."""
        scale = 1.0 if math.isfinite(self.hi - self.lo) else 0.5
        return (self.hi * scale - self.lo * scale) / buckets, scale


def group_sizes(frame: DataFrame, value: Column, by: Sequence[str], weight: Column) -> dict[Group, tuple[int, float, float]]:
    """Rows, smallest and largest value of each group, nulls left out."""
    rows = frame.where(value.isNotNull()).groupBy(*by).agg(F.sum(weight).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).collect()
    return {tuple(r[c] for c in by): (int(r["n"]), float(r["lo"]), float(r["hi"])) for r in rows if r["n"]}


def select_ranks(
    frame: DataFrame,
    value: str | Column,
    ranks: Mapping[Group, Sequence[int]],
    *,
    by: Sequence[str] = (),
    weight: str | None = None,
    buckets: int = BUCKETS,
    sizes: Mapping[Group, tuple[int, float, float]] | None = None,
) -> dict[Group, dict[int, float]]:
    """For each group (the values of its ``by`` columns) and each of its
    zero-based ranks the value there, in ascending order. ``weight`` is a
    column of multiplicities. Values must not be NaN; nulls are left out."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    w = (F.col(weight) if weight else F.lit(1)).cast("bigint")
    sizes = sizes if sizes is not None else group_sizes(frame, v, by, w)
    found: dict[Group, dict[int, float]] = {g: {} for g in ranks}
    wanted: dict[Range, set[int]] = {}
    for group, asked in ranks.items():
        n, lo, hi = sizes.get(group, (0, 0.0, 0.0))
        for rank in asked:
            if not 0 <= rank < n:
                raise ValueError("rank outside the data")
            wanted.setdefault(Range(group, lo, hi, 0), set()).add(rank)
    data = frame.select(*by, v.alias("_v"), w.alias("_w")).where(F.col("_v").isNotNull())
    while wanted:
        for r in [r for r in wanted if r.lo == r.hi]:
            for rank in wanted.pop(r):
                found[r.group][rank] = r.lo
        if not wanted:
            break
        open_ = sorted(wanted, key=lambda r: (str(r.group), r.below))
        width = max(2, min(buckets, PASS_ROWS // len(open_)))
        parts: dict[int, list] = {}
        for row in _histogram(data, by, open_, width).collect():
            parts.setdefault(row["_r"], []).append(row)
        narrowed: dict[Range, set[int]] = {}
        for i, r in enumerate(open_):
            below = r.below
            left = sorted(wanted[r])
            for row in sorted(parts[i], key=lambda row: row["_lo"]):
                inside = [k for k in left if k < below + row["_n"]]
                if inside:
                    narrowed.setdefault(Range(r.group, float(row["_lo"]), float(row["_hi"]), below), set()).update(inside)
                    left = left[len(inside):]
                below += row["_n"]
        wanted = narrowed
    return found


def _histogram(data: DataFrame, by: Sequence[str], open_: Sequence[Range], buckets: int) -> DataFrame:
    """``_r`` (number of the range), counts and limits of its buckets that
    hold a value: one aggregation for all ranges."""
    spark = data.sparkSession
    rows = [(*r.group, i, r.lo, r.hi, *r.step(buckets)) for i, r in enumerate(open_)]
    kinds = {f.name: f.dataType.simpleString() for f in data.schema.fields}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in by], "_r int", "_from double", "_to double", "_step double", "_scale double"])
    table = spark.createDataFrame(rows, schema)
    lists = table.groupBy(*by).agg(F.collect_list(F.struct("_r", "_from", "_to", "_step", "_scale")).alias("_open"))
    if by:
        # one row per group that still has an open range: as many as targets
        same = [data[c].eqNullSafe(lists[c]) for c in by]
        condition = same[0]
        for s in same[1:]:
            condition &= s
        met = data.join(F.broadcast(lists), condition).select("_v", "_w", "_open")
    else:
        met = data.withColumn("_open", lists.select("_open").scalar())
    v = F.col("_v")
    held = F.filter("_open", lambda o: (o["_from"] <= v) & (v <= o["_to"]))
    placed = met.select("_v", "_w", F.inline(held))
    at = v * F.col("_scale") - F.col("_from") * F.col("_scale")
    # a step below the smallest double leaves fewer distinct values than buckets
    bucket = F.when(F.col("_step") > 0, F.least(F.floor(at / F.col("_step")), F.lit(buckets - 1)).cast("double")).otherwise(v)
    return placed.groupBy("_r", bucket.alias("_b")).agg(F.sum("_w").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))


def kth_smallest(frame: DataFrame, value: str, rank: int, *, weight: str | None = None, buckets: int = 4096) -> float:
    """The value at zero-based ``rank`` in ascending order (rows counted
    ``weight`` times when a multiplicity column is given)."""
    return select_ranks(frame, value, {(): [rank]}, weight=weight, buckets=buckets)[()][rank]


def linear_position(n: int, q: float) -> tuple[int, int, float]:
    """The two zero-based ranks next to quantile ``q`` of ``n`` values and how
    far it lies between them."""
    at = q * (n - 1)
    low = math.floor(at)
    return low, min(low + 1, n - 1), at - low


def quantile_table(
    frame: DataFrame,
    value: str | Column,
    quantiles: Sequence[float],
    *,
    by: Sequence[str] = (),
    weight: str | None = None,
    buckets: int = BUCKETS,
) -> dict[Group, list[float]]:
    """The exact quantiles (linear interpolation between neighbours) of every
    group that has a value; groups are the values of their ``by`` columns.

    Groups are as many as a report has rows (features, windows, zones): their
    quantiles are held on the driver."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    w = (F.col(weight) if weight else F.lit(1)).cast("bigint")
    sizes = group_sizes(frame, v, by, w)
    asked = {g: sorted({k for q in quantiles for k in linear_position(n, q)[:2]}) for g, (n, _, _) in sizes.items()}
    values = select_ranks(frame, v, asked, by=by, weight=weight, buckets=buckets, sizes=sizes)
    out = {}
    for g, (n, _, _) in sizes.items():
        places = [linear_position(n, q) for q in quantiles]
        out[g] = [_between(values[g][low], values[g][high], part) for low, high, part in places]
    return out


def _between(low: float, high: float, part: float) -> float:
    """Linear interpolation, measured from the nearer end."""
    if low == high or part == 0:
        return low
    return low + (high - low) * part if part < 0.5 else high - (high - low) * (1 - part)


def quantile_frame(
    frame: DataFrame,
    value: str | Column,
    quantiles: Sequence[float],
    *,
    by: Sequence[str] = (),
    weight: str | None = None,
    name: str = "quantiles",
) -> DataFrame:
    """``quantile_table`` as a DataFrame: the ``by`` columns and an array of
    the quantiles, one row per group. Without ``by`` there is one row, also
    when there is no value (a null array)."""
    found = quantile_table(frame, value, quantiles, by=by, weight=weight)
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in by], f"`{name}` array<double>"])
    rows = [(*g, q) for g, q in found.items()]
    if not by and not rows:
        rows = [(None,)]
    return frame.sparkSession.createDataFrame(rows, schema)
