"""Zone lookup CSV reader."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.schemas import ZONE_LOOKUP_RAW_SCHEMA, require_columns


def read_zone_lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw lookup (``LocationID, Borough, Zone, service_zone``). Columns are
    found by their name in the header, in any order and beside others; all are
    read as text (no inference pass over the file) and cast to their declared
    type. A malformed line and an id that is no number are errors."""
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    require_columns(raw, ZONE_LOOKUP_RAW_SCHEMA.fieldNames(), "zone lookup")
    typed = [F.col(f.name) if isinstance(f.dataType, T.StringType) else F.trim(f.name).cast(f.dataType).alias(f.name) for f in ZONE_LOOKUP_RAW_SCHEMA]
    return raw.select(*typed)


def load_zone_lookup(spark: SparkSession, path: str, *, validate: bool = True) -> DataFrame:
    """CSV read + validation + normalisation."""
    from zonecast.operators.zones import normalize_zone_lookup

    return normalize_zone_lookup(read_zone_lookup_csv(spark, path), validate=validate)
