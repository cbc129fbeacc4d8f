"""Writers: marts and features as zstd Parquet, small reports as JSON."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_parquet(
    frame: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    sort_within: Sequence[str] = ("zone_id", "timestamp"),
    mode: str = "overwrite",
) -> str:
    """zstd Parquet with column statistics. Rows are sorted within each
    output partition only (no global sort), which keeps min/max statistics
    tight for time and zone predicates on later reads."""
    cols = [c for c in sort_within if c in frame.columns]
    out = frame.sortWithinPartitions(*cols) if cols else frame
    writer = out.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_json_report(frame: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    """A small report table (one row per month / fold / feature) as JSON
    lines in one file."""
    frame.coalesce(1).write.mode(mode).json(path)
    return path
