"""Session helpers: the settings every job in this package assumes."""
from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on. UTC keeps any TIMESTAMP (with zone) value
# printed the same everywhere; all event times here are TIMESTAMP_NTZ anyway.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    *,
    app_name: str = "zonecast",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster pass ``master=None`` and let ``spark-submit`` decide; the
    shuffle partition count should then be sized to the data (roughly
    shuffle bytes / 128 MB), AQE coalesces what is too small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_FALLBACK_DIRS: dict[int, str] = {}


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Point ``DataFrame.checkpoint`` at the shared folder the cluster names.

    The folder comes from ``spark.checkpoint.dir`` of the running session.
    Only when that setting is absent (local tests) do we create a private
    folder; on a cluster it must be a shared file system path.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = None
    try:  # classic sessions only; Spark Connect has no SparkContext
        context = spark.sparkContext
    except Exception:  # noqa: BLE001
        context = None
    if not configured and context is not None:
        configured = context.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        # executors elsewhere would each write to their own disk and a later
        # read would miss rows: only a local session gets a private folder
        # (remembered, as spark.checkpoint.dir cannot be set at runtime)
        master = context.master if context is not None else ""
        key = id(spark)
        local = re.fullmatch(r"local(\[[^]]*\])?", master) is not None
        if fallback is None and key not in _FALLBACK_DIRS and not local:
            raise RuntimeError("intermediate tables need a shared folder: set spark.checkpoint.dir")
        if key not in _FALLBACK_DIRS:
            _FALLBACK_DIRS[key] = fallback or tempfile.mkdtemp(prefix="zonecast-ckpt-")
        configured = _FALLBACK_DIRS[key]
    if "://" not in configured:
        os.makedirs(configured, exist_ok=True)
    if context is not None and context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def materialize(frame, *, name: str = "table"):
    """Write ``frame`` once as a Parquet table under the shared checkpoint
    folder (``spark.checkpoint.dir``) and return a DataFrame reading it.

    One job, one pass over the input: lineage is cut (a lost executor never
    forces recomputation from the raw scan), and the table carries file
    statistics for the planner. Used where one derived frame feeds several
    branches of a plan (grid bounds + zones + union, reference + current
    windows, the fold loop); without it every branch re-executes all the
    work below it, down to the scan.
    """
    spark = frame.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/zonecast-tables/{name}-{uuid.uuid4().hex}"
    frame.write.mode("error").parquet(path)
    return spark.read.parquet(path)
