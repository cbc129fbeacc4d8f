"""Dataset builds: one pass over the trips, one job for any number of months.

Months are data: every trip row carries the month window its pickup falls in
(or the month of its source file). The raw scan runs exactly once per build and
leaves an audit table behind, one row per (month, hour, zone, broken rules):

* quality counters are sums over it,
* the hourly counts of the mart are its rows without a broken rule.

Rows that break a rule keep no hour and no zone, so they add at most one row per
month and combination of rules. The audit table is as large as the mart,
whatever the number of trips, and everything after it reads that table.

``update_months`` rebuilds changed months only and leaves the files of all other
months as they are.
"""
from __future__ import annotations

import os
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.timecols import hour_floor
from zonecast.operators.mart import complete_hourly_grid
from zonecast.operators.quality import DEFAULT_RULES, FLAG_COLUMNS, QualityRules, flag_expressions
from zonecast.schemas import DEMAND_SCHEMA, TRIP_COLUMNS, require_columns
from zonecast.session import materialize
from zonecast.sources.sinks import write_json_report, write_parquet
from zonecast.sources.trips import pickup_window, read_monthly_trips

MONTH_FORMAT = "%Y-%m"


def month_labels(start: str, end: str) -> list[str]:
    """``2024-11`` to ``2025-01`` -> the labels of all months between."""
    first, last = (datetime.strptime(label, MONTH_FORMAT) for label in (start, end))
    if last < first:
        raise ValueError(f"the last month {end} lies before the first {start}")
    out = []
    while first <= last:
        out.append(first.strftime(MONTH_FORMAT))
        first = (first + timedelta(days=31)).replace(day=1)
    return out


def tag_months(trips: DataFrame, start: str, end: str) -> DataFrame:
    """Rows picked up in the months ``start`` to ``end`` (labels such as
    ``2024-01``), tagged with their month. A row that carries the month of its
    file (``source_month``) counts only in that month. This comes before the
    quality checks, so a missing pickup never enters a month."""
    labels = month_labels(start, end)
    first, last = (datetime.strptime(label, MONTH_FORMAT) for label in (labels[0], labels[-1]))
    window = pickup_window(trips, first, (last + timedelta(days=31)).replace(day=1))
    tagged = window.withColumn("month", F.date_format("tpep_pickup_datetime", "yyyy-MM"))
    if "source_month" in trips.columns:
        tagged = tagged.filter(F.col("source_month") == F.col("month")).drop("source_month")
    return tagged


# ---- the audit table -----------------------------------------------------------
def audit_trips(trips: DataFrame, rules: QualityRules = DEFAULT_RULES, *, by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns, ``timestamp`` and ``zone_id`` (null for rows that break a
    rule), ``broken`` (bit i: rule i of ``FLAG_COLUMNS``), ``rows``: all that a
    build needs to know, written once from one scan of the trips."""
    require_columns(trips, rules.required_columns, "required TLC")
    flags = flag_expressions(rules)
    broken = F.lit(0)
    for i, name in enumerate(FLAG_COLUMNS):
        broken = broken + F.when(flags[name], F.lit(1 << i)).otherwise(F.lit(0))
    marked = trips.select(*by, "tpep_pickup_datetime", "PULocationID", broken.alias("broken"))
    valid = F.col("broken") == 0
    keyed = marked.select(
        *by,
        F.when(valid, hour_floor("tpep_pickup_datetime")).alias("timestamp"),
        F.when(valid, F.col("PULocationID").cast("smallint")).alias("zone_id"),
        "broken",
    )
    return materialize(keyed.groupBy(*by, "timestamp", "zone_id", "broken").agg(F.count(F.lit(1)).alias("rows")), name="audit")


def audit_report(audit: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """The counters of ``quality_report`` from an audit table."""
    rows = F.col("rows")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, rows)), F.lit(0))
    sums = audit.groupBy(*by).agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("input_rows"),
        total(F.col("broken") == 0).alias("valid_rows"),
        *[total(F.col("broken").bitwiseAND(1 << i) != 0).alias(f"{name}_rows") for i, name in enumerate(FLAG_COLUMNS)],
    )
    return sums.select(
        *by,
        "input_rows",
        "valid_rows",
        (F.col("input_rows") - F.col("valid_rows")).alias("dropped_rows"),
        *[f"{name}_rows" for name in FLAG_COLUMNS],
        F.when(F.col("input_rows") == 0, F.lit(0.0)).otherwise(F.col("valid_rows") / F.col("input_rows")).alias("valid_share"),
    )


def audit_counts(audit: DataFrame) -> DataFrame:
    """Hourly counts ``timestamp, zone_id, demand`` from an audit table."""
    return audit.filter(F.col("broken") == 0).select("timestamp", "zone_id", F.col("rows").cast("int").alias("demand"))


def _grid(counts: DataFrame) -> DataFrame:
    """The complete grid over counts that are a written table already."""
    zones = counts.agg(F.count_distinct("zone_id")).first()[0]
    if not zones:
        raise ValueError("no trip passes the quality rules")
    width = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return complete_hourly_grid(counts, num_partitions=max(1, min(width, zones)), materialize_counts=False)


def build_manifest(trips: DataFrame, start: str, end: str, rules: QualityRules = DEFAULT_RULES) -> tuple[DataFrame, DataFrame]:
    """(merged mart, manifest). The manifest has one row per month with
    the quality counters plus the merged mart's row and zone counts. One scan
    of the trips serves both."""
    audit = audit_trips(tag_months(trips, start, end), rules, by=["month"])
    counts = audit_counts(audit)
    mart = _grid(counts)
    # the grid's size follows from the counts: no need to build it to know it
    size = counts.agg(
        F.struct(
            F.count_distinct("zone_id").alias("zones"),
            ((F.unix_timestamp(F.max("timestamp")) - F.unix_timestamp(F.min("timestamp"))) / 3600 + 1).cast("bigint").alias("hours"),
        )
    ).scalar()
    manifest = audit_report(audit, by=["month"]).select(
        "*",
        F.lit(start).alias("start_month"),
        F.lit(end).alias("end_month"),
        (size.getField("zones") * size.getField("hours")).alias("merged_rows"),
        size.getField("zones").alias("merged_zones"),
    )
    return mart, manifest


# ---- writing -------------------------------------------------------------------
def month_path(output_dir: str, month: str) -> str:
    return os.path.join(output_dir, "monthly", f"month={month}")


def write_months(counts: DataFrame, output_dir: str, months: Sequence[str]) -> None:
    """Replace the files of ``months`` by what ``counts`` (with ``month``, none
    of other months) holds, one sorted file group a month; other months stay
    untouched. Readers see a month's old files or its new ones (dynamic
    partition overwrite). A month without counts gets an empty file."""
    ordered = counts.repartition("month").sortWithinPartitions("month", "zone_id", "timestamp")
    writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.partitionBy("month").parquet(os.path.join(output_dir, "monthly"))
    held = {r["month"] for r in counts.select("month").distinct().collect()}
    for label in set(months) - held:
        counts.sparkSession.createDataFrame([], DEMAND_SCHEMA).write.mode("overwrite").parquet(month_path(output_dir, label))


def read_months(spark: SparkSession, output_dir: str) -> DataFrame:
    """All monthly counts written so far, with their ``month``."""
    from pyspark.sql import types as T

    schema = T.StructType([*DEMAND_SCHEMA.fields, T.StructField("month", T.StringType())])
    return spark.read.schema(schema).parquet(os.path.join(output_dir, "monthly"))


def build_dataset_range(
    trips: DataFrame,
    start: str,
    end: str,
    output_dir: str,
    *,
    rules: QualityRules = DEFAULT_RULES,
) -> DataFrame:
    """Write the hourly counts of each month, the merged mart (zstd Parquet,
    partitioned by month) and the manifest (JSON); returns the manifest: one row
    per month with its counters, where its output lies (null for a month without
    a valid trip) and the merged mart's path, rows and zones."""
    audit = audit_trips(tag_months(trips, start, end), rules, by=["month"])
    counts = audit.filter(F.col("broken") == 0).select("timestamp", "zone_id", F.col("rows").cast("int").alias("demand"), "month")
    write_months(counts, output_dir, month_labels(start, end))
    return _publish(audit_report(audit, by=["month"]), counts, start, end, output_dir)


def _publish(report: DataFrame, counts: DataFrame, start: str, end: str, output_dir: str) -> DataFrame:
    """The merged mart of ``counts`` and the manifest of ``report``, written."""
    merged = os.path.join(output_dir, "demand")
    mart = _grid(counts.drop("month")).withColumn("month", F.date_format("timestamp", "yyyy-MM"))
    # one task a month, so one file group a month: a month of the mart is hours x zones rows
    write_parquet(mart.repartition("month"), merged, partition_by=("month",))
    spark = counts.sparkSession
    written = spark.read.schema(DEMAND_SCHEMA).parquet(merged)
    size = written.agg(F.struct(F.count(F.lit(1)).alias("rows"), F.count_distinct("zone_id").alias("zones"))).scalar()
    place = F.concat(F.lit(month_path(output_dir, "")), F.col("month"))
    manifest = report.select(
        "*",
        F.when(F.col("valid_rows") > 0, place).alias("monthly_output"),
        F.lit(start).alias("start_month"),
        F.lit(end).alias("end_month"),
        F.lit(merged).alias("merged_output"),
        size.getField("rows").alias("merged_rows"),
        size.getField("zones").alias("merged_zones"),
    )
    write_json_report(manifest.orderBy("month"), os.path.join(output_dir, "manifest"))
    return read_manifest(spark, output_dir)


MANIFEST_SCHEMA = (
    "month string, input_rows long, valid_rows long, dropped_rows long, "
    + ", ".join(f"{name}_rows long" for name in FLAG_COLUMNS)
    + ", valid_share double, monthly_output string, start_month string, end_month string, merged_output string, merged_rows long, merged_zones long"
)


def read_manifest(spark: SparkSession, output_dir: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).option("mode", "FAILFAST").json(os.path.join(output_dir, "manifest"))


def update_months(trips: DataFrame, months: Sequence[str], output_dir: str, *, rules: QualityRules = DEFAULT_RULES) -> DataFrame:
    """Bring a written range up to date after the trips of ``months`` changed
    (or came in): scans those months' pickup windows only, rewrites their
    monthly outputs and no other, and publishes the merged mart and manifest
    again from the monthly counts. Equal to a full build of the same trips.

    The new manifest covers the months known before and ``months``; a month
    whose trips are all gone keeps a row of zeros and an empty output."""
    spark = trips.sparkSession
    changed = sorted(set(months))
    if not changed:
        raise ValueError("no month to update")
    known = materialize(read_manifest(spark, output_dir), name="manifest")
    old = {r["month"] for r in known.select("month").collect()}
    windows = None
    for label in changed:
        tagged = tag_months(trips, label, label)
        windows = tagged if windows is None else windows.unionByName(tagged)
    audit = audit_trips(windows, rules, by=["month"])
    fresh = audit.filter(F.col("broken") == 0).select("timestamp", "zone_id", F.col("rows").cast("int").alias("demand"), "month")
    # read before the files change: months that stay keep their counts
    kept = read_months(spark, output_dir).filter(~F.col("month").isin(changed))
    write_months(fresh, output_dir, changed)
    asked = spark.createDataFrame([(m,) for m in changed], "month string")
    report = audit_report(audit, by=["month"])
    zeros = {c: F.coalesce(F.col(c), F.lit(0)).alias(c) for c in report.columns if c not in ("month", "valid_share")}
    filled = asked.join(report, "month", "left").select("month", *zeros.values(), F.coalesce("valid_share", F.lit(0.0)).alias("valid_share"))
    table = known.filter(~F.col("month").isin(changed)).select(*filled.columns).unionByName(filled)
    span = sorted(old | set(changed))
    counts = materialize(kept.unionByName(fresh), name="monthly-counts")
    return _publish(materialize(table, name="manifest"), counts, span[0], span[-1], output_dir)


def build_from_files(spark: SparkSession, paths: str | Sequence[str], start: str, end: str, output_dir: str, *, rules: QualityRules = DEFAULT_RULES) -> DataFrame:
    """``build_dataset_range`` over monthly trip files; files of other months
    are not opened."""
    trips = read_monthly_trips(spark, paths, months=month_labels(start, end))
    return build_dataset_range(trips, start, end, output_dir, rules=rules)


def aggregate_file(
    trips: DataFrame,
    output_dir: str,
    *,
    start_time: datetime | None = None,
    end_time: datetime | None = None,
    rules: QualityRules = DEFAULT_RULES,
) -> str:
    """Window -> clean -> mart -> Parquet, quality report as a JSON sidecar.
    One scan of the trips serves both."""
    require_columns(trips, TRIP_COLUMNS, "required TLC")
    audit = audit_trips(pickup_window(trips, start_time, end_time), rules)
    write_parquet(_grid(audit_counts(audit)), os.path.join(output_dir, "demand"))
    write_json_report(audit_report(audit), os.path.join(output_dir, "quality"))
    return output_dir
