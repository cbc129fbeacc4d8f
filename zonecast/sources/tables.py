"""Readers of the tables this package writes: marts, features, scored windows.

Each reader takes its columns by name, checks them against the declared
schema and casts them to it; other columns stay as they are (features) or are
left out (marts). Nothing is scanned before an action."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.schemas import DEMAND_SCHEMA, require_columns

#: What a scored window holds beside monitored features.
SCORED_SCHEMA = T.StructType([T.StructField("actual", T.DoubleType()), T.StructField("prediction", T.DoubleType())])


def _typed(frame: DataFrame, schema: T.StructType, what: str) -> DataFrame:
    require_columns(frame, schema.fieldNames(), what)
    for field in schema:
        held = frame.schema[field.name].dataType
        if isinstance(field.dataType, T.NumericType) and not isinstance(held, T.NumericType):
            raise ValueError(f"{what} column {field.name} holds {held.simpleString()}, not numbers")
    return frame.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in schema})


def read_demand(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """An hourly mart: ``timestamp`` (NTZ), ``zone_id`` SMALLINT, ``demand`` INT."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return _typed(spark.read.parquet(*paths), DEMAND_SCHEMA, "demand").select(*DEMAND_SCHEMA.fieldNames())


def read_features(spark: SparkSession, paths: str | Sequence[str], *, feature_columns: Sequence[str] = ()) -> DataFrame:
    """A feature table: the mart's columns typed as there, all others as they
    are written; ``feature_columns`` must be present and numeric."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    schema = T.StructType([*DEMAND_SCHEMA.fields[:2], *[T.StructField(c, T.DoubleType()) for c in feature_columns if c not in DEMAND_SCHEMA.fieldNames()]])
    frame = spark.read.parquet(*paths)
    checked = _typed(frame, schema, "feature")
    return checked.withColumns({c: F.col(c).cast(frame.schema[c].dataType) for c in feature_columns})


def read_scored_window(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    feature_columns: Sequence[str] = (),
    actual_column: str = "actual",
    prediction_column: str = "prediction",
) -> DataFrame:
    """A scored window: actual, prediction and the monitored features as
    doubles, nothing else (columns that are not asked for are not read)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    names = dict.fromkeys([actual_column, prediction_column, *feature_columns])
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    return _typed(spark.read.parquet(*paths), schema, "scored").select(*names)
