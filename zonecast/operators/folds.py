"""Expanding-window folds and leakage-safe fold membership.

Fold boundaries depend only on the first and last timestamp, so they are
computed from one two-value aggregate (the reference builds the same list
on the driver). Membership is then plain column arithmetic: fold ``f`` has

    validation_start(f) = origin + train + (f - 1) * step
    validation_end(f)   = validation_start(f) + validation

so a row's candidate folds are an interval of fold numbers that is
generated per row (``sequence`` + ``explode``) and checked exactly. No join
against the fold table is needed, and a validation row is copied to at most
``ceil(validation / step)`` folds.

Training counts use the per-hour row counts (bounded by the number of
hours, not by the data) expanded to the folds whose training window holds
that hour.
"""
from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.timecols import add_seconds, ntz_literal, seconds_between

DAY = 86_400
HOUR = 3_600

FOLD_SCHEMA = T.StructType(
    [
        T.StructField("fold", T.IntegerType(), False),
        T.StructField("train_start", T.TimestampNTZType(), False),
        T.StructField("train_end", T.TimestampNTZType(), False),
        T.StructField("validation_start", T.TimestampNTZType(), False),
        T.StructField("validation_end", T.TimestampNTZType(), False),
    ]
)


@dataclass(frozen=True)
class FoldPlan:
    origin: datetime
    end: datetime
    train_days: int
    validation_days: int
    step_days: int
    count: int

    @property
    def first_validation_start(self) -> datetime:
        return self.origin + timedelta(days=self.train_days)

    def boundaries(self) -> list[tuple[int, datetime, datetime, datetime, datetime]]:
        out = []
        for f in range(1, self.count + 1):
            vs = self.first_validation_start + timedelta(days=self.step_days * (f - 1))
            out.append((f, self.origin, vs, vs, vs + timedelta(days=self.validation_days)))
        return out

    # -- column arithmetic ------------------------------------------------
    def validation_start(self, fold: Column) -> Column:
        return add_seconds(ntz_literal(self.first_validation_start), (fold - 1) * F.lit(self.step_days * DAY))

    def validation_end(self, fold: Column) -> Column:
        return add_seconds(self.validation_start(fold), F.lit(self.validation_days * DAY))

    def table(self, spark: SparkSession) -> DataFrame:
        """The fold table (``fold`` + four boundaries); ``count`` rows."""
        return spark.createDataFrame(self.boundaries(), FOLD_SCHEMA)

    def validation_rows(self, frame: DataFrame, *, label_guard: bool = True) -> DataFrame:
        """Rows tagged with every fold whose validation window holds their
        ``timestamp`` (and, with ``label_guard``, whose label time
        ``forecast_timestamp`` is before the validation end)."""
        if self.count == 0:
            return frame.withColumn("fold", F.lit(None).cast("int")).limit(0)
        offset = seconds_between(ntz_literal(self.first_validation_start), F.col("timestamp"))
        newest = F.floor(offset / F.lit(self.step_days * DAY)).cast("int") + 1
        span = math.ceil(self.validation_days / self.step_days)
        candidates = F.sequence(newest - (span - 1), newest)
        tagged = frame.withColumn("fold", F.explode(candidates))
        f = F.col("fold")
        keep = (f >= 1) & (f <= self.count)
        keep &= (F.col("timestamp") >= self.validation_start(f)) & (F.col("timestamp") < self.validation_end(f))
        if label_guard:
            keep &= F.col("forecast_timestamp") < self.validation_end(f)
        return tagged.filter(keep)

    def first_training_fold(self, *, label_guard: bool = True) -> Column:
        """The first fold whose validation starts strictly after the row (and,
        with ``label_guard``, its label): that fold and all later ones train
        on it. Beyond ``count`` for rows that no fold trains on."""
        newest = F.greatest(F.col("timestamp"), F.col("forecast_timestamp") if label_guard else F.col("timestamp"))
        offset = seconds_between(ntz_literal(self.first_validation_start), newest)
        return F.when(offset < 0, F.lit(1)).otherwise(F.floor(offset / F.lit(self.step_days * DAY)).cast("int") + 2)

    def train_counts(self, frame: DataFrame, *, label_guard: bool) -> DataFrame:
        """``fold, train_rows``: rows with ``origin <= timestamp <
        validation_start`` (and, with ``label_guard``, ``forecast_timestamp
        < validation_start``), counted from an hourly pre-aggregate."""
        keys = ["timestamp"] + (["forecast_timestamp"] if label_guard else [])
        hourly = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        first = self.first_training_fold(label_guard=label_guard)
        expanded = hourly.filter(first <= self.count).withColumn(
            "fold", F.explode(F.sequence(first, F.lit(self.count)))
        )
        expanded = expanded.filter(F.col("timestamp") >= ntz_literal(self.origin))
        return expanded.groupBy("fold").agg(F.sum("_rows").alias("train_rows"))


def plan_expanding_folds(
    frame: DataFrame, *, train_days: int, validation_days: int, step_days: int
) -> FoldPlan:
    """Fold boundaries from the frame's first and last ``timestamp``.

    Fold ``f`` exists while ``validation_start + validation <= last + 1h``;
    steps shorter than the validation window give overlapping folds.
    Runs one global min/max aggregate.
    """
    if min(train_days, validation_days, step_days) <= 0:
        raise ValueError("window sizes must be positive")
    if "timestamp" not in frame.columns:
        raise ValueError("frame must contain non-empty timestamp data")
    row = frame.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
    if row is None or row["lo"] is None:
        raise ValueError("frame must contain non-empty timestamp data")
    origin, end = row["lo"], row["hi"]
    if not isinstance(origin, datetime):
        raise TypeError("timestamp must contain datetime values")
    first_vs = origin + timedelta(days=train_days)
    limit = end + timedelta(hours=1) - timedelta(days=validation_days)
    count = 0 if limit < first_vs else (limit - first_vs) // timedelta(days=step_days) + 1
    return FoldPlan(origin, end, train_days, validation_days, step_days, int(count))


def expanding_window_folds(
    frame: DataFrame, *, train_days: int, validation_days: int, step_days: int
) -> DataFrame:
    """The fold table as a DataFrame (may be empty)."""
    plan = plan_expanding_folds(
        frame, train_days=train_days, validation_days=validation_days, step_days=step_days
    )
    return plan.table(frame.sparkSession)

