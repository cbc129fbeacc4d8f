from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import types as T

from zonecast.schemas import DEMAND_SCHEMA, TRIP_SCHEMA


def trips_df(spark, rows):
    """rows: (pickup, dropoff, pu, distance)"""
    data = [(p, d, pu, 1, dist, 10.0) for p, d, pu, dist in rows]
    return spark.createDataFrame(data, TRIP_SCHEMA)


def demand_df(spark, rows):
    return spark.createDataFrame([(t, int(z), int(d)) for t, z, d in rows], DEMAND_SCHEMA)


def hourly_series(spark, start: datetime, values, zone=161, extra=None):
    rows = [(start + timedelta(hours=i), zone, int(v)) for i, v in enumerate(values)]
    return demand_df(spark, rows)


def scored_df(spark, actual, prediction, **extra):
    cols = {"actual": [float(a) for a in actual], "prediction": [float(p) for p in prediction], **extra}
    names = list(cols)
    fields = [T.StructField(n, T.DoubleType()) if n != "timestamp" else T.StructField(n, T.TimestampNTZType()) for n in names]
    return spark.createDataFrame(list(zip(*[cols[n] for n in names])), T.StructType(fields))
