"""Registered queries over the driver tables and their SQL oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads the given tables
(``events`` as trips, ``nation`` + ``region`` as the zone lookup) in full;
the logic lives in the operators, this module only wires parameters.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast import oracle_sql as O
from zonecast.operators import features as feat
from zonecast.operators import folds as fo
from zonecast.operators import horizons as hz
from zonecast.operators import mart as mt
from zonecast.operators import quality as q
from zonecast.plans import backtest as bt
from zonecast.plans import fold_glm as fg
from zonecast.sources import driver_tables as dt

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the registered queries on the 30-day driver data.
HORIZON = 6
TRAIN_DAYS, VALIDATION_DAYS, STEP_DAYS = 14, 4, 4
SCAN_START, SCAN_END = "2024-01-03 00:00:00", "2024-01-28 00:00:00"
PLACES = 6


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def round_doubles(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Output-edge rounding of every DOUBLE column (floating sums may
    differ in the last bit between engines)."""
    return df.select(
        *[
            F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# ---- shared pipelines -------------------------------------------------------
def _trips(spark, sf):
    return dt.trips(spark, sf)


def _mart(spark, sf):
    return mt.aggregate_hourly_demand(_trips(spark, sf))


def _features(spark, sf):
    return feat.build_features(_mart(spark, sf))


def _baseline(spark, sf, h=HORIZON):
    return hz.attach_direct_seasonal_baseline(_mart(spark, sf), horizon_hours=h)


def _fold_plan(supervised):
    return fo.plan_expanding_folds(
        supervised, train_days=TRAIN_DAYS, validation_days=VALIDATION_DAYS, step_days=STEP_DAYS
    )


TRIP_COLS = "tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID, trip_distance, total_amount"

# ---- scans and quality -------------------------------------------------------
register(
    "windowed_scan",
    O.with_ctes(
        f"SELECT {TRIP_COLS} FROM trips WHERE tpep_pickup_datetime >= TIMESTAMP '{SCAN_START}' "
        f"AND tpep_pickup_datetime < TIMESTAMP '{SCAN_END}'",
        "trips",
    ),
)(lambda spark, sf: dt.trips(spark, sf, SCAN_START, SCAN_END))

register(
    "quality_flags",
    O.with_ctes(f"SELECT * FROM flags", "flags"),
)(lambda spark, sf: q.quality_flags(_trips(spark, sf)))

register(
    "clean_trips",
    O.with_ctes("SELECT * FROM clean", "clean"),
)(lambda spark, sf: q.clean_trips(_trips(spark, sf)))

register(
    "quality_report",
    O.rounded(
        O.with_ctes(
            """
SELECT count(*) AS input_rows,
       count(*) FILTER (WHERE NOT (null_pickup OR invalid_zone OR invalid_duration OR invalid_distance)) AS valid_rows,
       count(*) - count(*) FILTER (WHERE NOT (null_pickup OR invalid_zone OR invalid_duration OR invalid_distance)) AS dropped_rows,
       count(*) FILTER (WHERE null_pickup) AS null_pickup_rows,
       count(*) FILTER (WHERE invalid_zone) AS invalid_zone_rows,
       count(*) FILTER (WHERE invalid_duration) AS invalid_duration_rows,
       count(*) FILTER (WHERE invalid_distance) AS invalid_distance_rows,
       CASE WHEN count(*) = 0 THEN 0.0 ELSE
         count(*) FILTER (WHERE NOT (null_pickup OR invalid_zone OR invalid_duration OR invalid_distance)) / count(*) END AS valid_share
FROM flags""",
            "flags",
        ),
        ["valid_share"],
    ),
)(lambda spark, sf: round_doubles(q.quality_report(_trips(spark, sf))))

# ---- mart -------------------------------------------------------------------
register("hourly_counts", O.with_ctes("SELECT * FROM counts", "counts"))(
    lambda spark, sf: mt.aggregate_hourly_demand(_trips(spark, sf), complete_grid=False)
)

register("hourly_demand_grid", O.with_ctes("SELECT * FROM mart", "mart"))(_mart)

# ---- features ---------------------------------------------------------------
register(
    "calendar_features",
    O.with_ctes(f"SELECT timestamp, zone_id, demand, {O._calendar_sql()} FROM mart", "mart"),
)(lambda spark, sf: feat.add_calendar_features(_mart(spark, sf)))

register(
    "lag_features",
    O.with_ctes(f"SELECT timestamp, zone_id, demand, {O._lags_sql()} FROM mart", "mart"),
)(lambda spark, sf: feat.add_lag_features(_mart(spark, sf)))

register(
    "rolling_features",
    O.rounded(O.with_ctes(f"SELECT timestamp, zone_id, demand, {O._rolling_sql()} FROM mart", "mart"), O.ROLL_COLUMNS),
)(lambda spark, sf: round_doubles(feat.add_rolling_features(_mart(spark, sf))))

register(
    "build_features",
    O.rounded(O.with_ctes("SELECT * FROM features", "features"), O.ROLL_COLUMNS),
)(lambda spark, sf: round_doubles(_features(spark, sf)))

BLOCK_HOURS = 96
register(
    "build_features_in_blocks",
    O.rounded(O.with_ctes("SELECT * FROM features", "features"), O.ROLL_COLUMNS),
)(lambda spark, sf: round_doubles(feat.build_features(_mart(spark, sf), block_hours=BLOCK_HOURS)))

# ---- horizons and baselines ---------------------------------------------------
for _h in (1, 6, 24):
    register(
        f"horizon_dataset_{_h}h",
        O.with_ctes(
            f"SELECT * FROM (SELECT timestamp, zone_id, demand, lead(demand, {_h}) OVER ({O.W}) AS target_demand, "
            f"timestamp + INTERVAL {_h} HOUR AS forecast_timestamp FROM mart) WHERE target_demand IS NOT NULL",
            "mart",
        ),
    )(lambda spark, sf, _h=_h: hz.make_horizon_dataset(_mart(spark, sf), horizon_hours=_h))

register(
    "seasonal_naive",
    O.with_ctes(
        f"SELECT timestamp, zone_id, demand, CAST(lag(demand, 168) OVER ({O.W}) AS DOUBLE) AS prediction FROM mart",
        "mart",
    ),
)(lambda spark, sf: hz.seasonal_naive(_mart(spark, sf)))

O.baseline_ctes(HORIZON)
register(
    "direct_seasonal_baseline",
    O.with_ctes(f"SELECT * FROM bbase{HORIZON}", f"bbase{HORIZON}"),
)(lambda spark, sf: _baseline(spark, sf))

register(
    "direct_seasonal_baseline_in_blocks",
    O.with_ctes(f"SELECT * FROM bbase{HORIZON}", f"bbase{HORIZON}"),
)(lambda spark, sf: hz.attach_direct_seasonal_baseline(_mart(spark, sf), horizon_hours=HORIZON, block_hours=BLOCK_HOURS))

# ---- folds and backtests --------------------------------------------------------
O.fold_ctes(f"bbase{HORIZON}", TRAIN_DAYS, VALIDATION_DAYS, STEP_DAYS, "bfolds")


@register("expanding_folds", O.with_ctes("SELECT * FROM bfolds", "bfolds"))
def _expanding_folds(spark, sf):
    return fo.expanding_window_folds(
        _baseline(spark, sf), train_days=TRAIN_DAYS, validation_days=VALIDATION_DAYS, step_days=STEP_DAYS
    )


@register(
    "fold_rows",
    O.with_ctes(
        """
SELECT v.fold, t.train_rows, v.validation_rows FROM
 (SELECT f.fold, count(*) AS validation_rows FROM bbase6 b JOIN bfolds f
    ON b.timestamp >= f.validation_start AND b.timestamp < f.validation_end
   AND b.forecast_timestamp < f.validation_end GROUP BY f.fold) v
JOIN
 (SELECT f.fold, count(*) AS train_rows FROM bbase6 b JOIN bfolds f
    ON b.timestamp >= f.train_start AND b.timestamp < f.train_end
   AND b.forecast_timestamp < f.validation_start GROUP BY f.fold) t
ON v.fold = t.fold
""",
        "bbase6",
        "bfolds",
    ),
)
def _fold_rows(spark, sf):
    """Leakage-safe membership counts: training rows need their label before
    the validation start, validation rows before the validation end."""
    supervised = _baseline(spark, sf)
    plan = _fold_plan(supervised)
    validation = plan.validation_rows(supervised).groupBy("fold").agg(F.count(F.lit(1)).alias("validation_rows"))
    train = plan.train_counts(supervised, label_guard=True)
    return validation.join(train, "fold").select(F.col("fold").cast("int"), "train_rows", "validation_rows")


BASELINE_BACKTEST_SQL = f"""
SELECT m.fold, CAST({HORIZON} AS INTEGER) AS horizon_hours, t.train_rows, m.validation_rows, m.mae, m.rmse, m.wape, m.smape
FROM (SELECT f.fold, count(*) AS validation_rows, {O.metric_sql('b.target_demand', 'b.prediction')}
      FROM bbase6 b JOIN bfolds f
        ON b.timestamp >= f.validation_start AND b.timestamp < f.validation_end
       AND b.forecast_timestamp < f.validation_end
      GROUP BY f.fold) m
JOIN (SELECT f.fold, count(*) AS train_rows FROM bbase6 b JOIN bfolds f
        ON b.timestamp >= f.train_start AND b.timestamp < f.train_end GROUP BY f.fold) t
  ON m.fold = t.fold
"""
O.cte("baseline_backtest", BASELINE_BACKTEST_SQL, "bbase6", "bfolds")


def _baseline_backtest(spark, sf):
    return bt.backtest_seasonal_baseline(
        _mart(spark, sf), horizon_hours=HORIZON, train_days=TRAIN_DAYS,
        validation_days=VALIDATION_DAYS, step_days=STEP_DAYS,
    )


register(
    "baseline_backtest",
    O.rounded(O.with_ctes("SELECT * FROM baseline_backtest", "baseline_backtest"), ["mae", "rmse", "wape", "smape"]),
)(lambda spark, sf: round_doubles(_baseline_backtest(spark, sf)))

register(
    "backtest_summary",
    O.rounded(
        O.with_ctes(
            "SELECT avg(mae) AS mae, avg(rmse) AS rmse, avg(wape) AS wape, avg(smape) AS smape FROM baseline_backtest",
            "baseline_backtest",
        ),
        ["mae", "rmse", "wape", "smape"],
    ),
)(lambda spark, sf: round_doubles(bt.summarize_folds(_baseline_backtest(spark, sf))))


# ---- baseline backtests at the other direct horizons --------------------------------
def _baseline_backtest_sql(h: int) -> str:
    O.baseline_ctes(h)
    O.fold_ctes(f"bbase{h}", TRAIN_DAYS, VALIDATION_DAYS, STEP_DAYS, f"bfolds{h}")
    return O.rounded(
        O.with_ctes(
            f"""
SELECT m.fold, CAST({h} AS INTEGER) AS horizon_hours, t.train_rows, m.validation_rows, m.mae, m.rmse, m.wape, m.smape
FROM (SELECT f.fold, count(*) AS validation_rows, {O.metric_sql('b.target_demand', 'b.prediction')}
      FROM bbase{h} b JOIN bfolds{h} f
        ON b.timestamp >= f.validation_start AND b.timestamp < f.validation_end
       AND b.forecast_timestamp < f.validation_end
      GROUP BY f.fold) m
JOIN (SELECT f.fold, count(*) AS train_rows FROM bbase{h} b JOIN bfolds{h} f
        ON b.timestamp >= f.train_start AND b.timestamp < f.train_end GROUP BY f.fold) t
  ON m.fold = t.fold""",
            f"bbase{h}",
            f"bfolds{h}",
        ),
        ["mae", "rmse", "wape", "smape"],
    )


for _h in (1, 24):
    register(f"baseline_backtest_{_h}h", _baseline_backtest_sql(_h))(
        lambda spark, sf, _h=_h: round_doubles(
            bt.backtest_seasonal_baseline(
                _mart(spark, sf), horizon_hours=_h, train_days=TRAIN_DAYS,
                validation_days=VALIDATION_DAYS, step_days=STEP_DAYS,
            )
        )
    )


# ---- zone lookup ------------------------------------------------------------------
from zonecast.operators import diagnostics as dg  # noqa: E402
from zonecast.operators import eda  # noqa: E402
from zonecast.operators import intervals as iv  # noqa: E402
from zonecast.operators import monitoring as mon  # noqa: E402
from zonecast.operators import sampling as smp  # noqa: E402
from zonecast.operators import zones as zn  # noqa: E402
from zonecast.functions import metrics as M  # noqa: E402
from zonecast.functions.status import classify_performance_regression  # noqa: E402
from zonecast.sources.trips import month_windows  # noqa: E402
from zonecast.functions.timecols import ntz_literal  # noqa: E402
from zonecast.session import ensure_checkpoint_dir, materialize  # noqa: E402


def _lookup(spark, sf):
    return zn.normalize_zone_lookup(dt.zone_lookup_raw(spark, sf), validate=False)


register("zone_lookup_normalize", O.with_ctes("SELECT * FROM zone_lookup", "zone_lookup"))(_lookup)

register(
    "zone_lookup_violations",
    O.with_ctes(
        """
SELECT count(*) AS lookup_rows,
       (SELECT count(*) FROM (SELECT LocationID FROM zone_raw WHERE LocationID IS NOT NULL
                               GROUP BY LocationID HAVING count(*) > 1)) AS duplicate_ids,
       count(*) FILTER (WHERE LocationID IS NULL OR NOT (LocationID BETWEEN 1 AND 265)) AS invalid_ids
FROM zone_raw""",
        "zone_raw",
    ),
)(lambda spark, sf: zn.zone_lookup_violations(dt.zone_lookup_raw(spark, sf)))


def _onehot_sql() -> str:
    from zonecast.schemas import safe_name

    parts = [f"CAST(coalesce(l.borough, 'Unknown') = '{b}' AS TINYINT) AS borough_{safe_name(b)}" for b in dt.DRIVER_BOROUGHS]
    parts += [
        f"CAST(coalesce(l.service_zone, 'Unknown') = '{z}' AS TINYINT) AS service_zone_{safe_name(z)}"
        for z in dt.DRIVER_SERVICE_ZONES
    ]
    return ", ".join(parts)


register(
    "zone_one_hots",
    O.with_ctes(
        f"SELECT m.timestamp, m.zone_id, m.demand, {_onehot_sql()} FROM mart m LEFT JOIN zone_lookup l ON m.zone_id = l.zone_id",
        "mart",
        "zone_lookup",
    ),
)(
    lambda spark, sf: zn.add_zone_features(
        _mart(spark, sf), _lookup(spark, sf), boroughs=dt.DRIVER_BOROUGHS, service_zones=dt.DRIVER_SERVICE_ZONES
    )
)

# ---- month windows and merged marts -------------------------------------------------
MERGE_SPLIT = "2024-01-16 00:00:00"


@register(
    "month_windows",
    O.with_ctes(
        """
SELECT strftime(ms, '%Y-%m') AS month, ms AS window_start, ms + INTERVAL 1 MONTH AS window_end,
       (SELECT count(*) FROM trips t WHERE t.tpep_pickup_datetime >= ms
          AND t.tpep_pickup_datetime < ms + INTERVAL 1 MONTH) AS input_rows
FROM (SELECT unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP), CAST(date_trunc('month', hi) AS TIMESTAMP),
                                    INTERVAL 1 MONTH)) AS ms
      FROM (SELECT min(tpep_pickup_datetime) AS lo, max(tpep_pickup_datetime) AS hi FROM trips))""",
        "trips",
    ),
)
def _month_windows(spark, sf):
    trips = _trips(spark, sf)
    pickup = F.col("tpep_pickup_datetime")
    bounds = trips.agg(F.min(pickup).alias("lo"), F.max(pickup).alias("hi"))
    months = month_windows(bounds)
    per_month = trips.filter(pickup.isNotNull()).groupBy(
        F.make_timestamp_ntz(F.year(pickup), F.month(pickup), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("window_start")
    ).agg(F.count(F.lit(1)).alias("input_rows"))
    # both sides hold one row per month of data
    return months.join(per_month, "window_start", "left").select(
        "month", "window_start", "window_end", F.coalesce("input_rows", F.lit(0)).alias("input_rows")
    )


def _period_sql(cond: str, name: str) -> None:
    O.cte(f"{name}_counts", f"SELECT * FROM counts_src WHERE {cond}", "counts_src")
    O.cte(
        name,
        f"""
SELECT h.timestamp, z.zone_id, CAST(coalesce(c.demand, 0) AS INTEGER) AS demand
FROM (SELECT unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR)) AS timestamp FROM {name}_counts) h
CROSS JOIN (SELECT DISTINCT zone_id FROM {name}_counts) z
LEFT JOIN {name}_counts c ON c.timestamp = h.timestamp AND c.zone_id = z.zone_id""",
        f"{name}_counts",
    )


O.cte(
    "counts_src",
    f"""
SELECT date_trunc('hour', tpep_pickup_datetime) AS timestamp, CAST(PULocationID AS SMALLINT) AS zone_id,
       tpep_pickup_datetime < TIMESTAMP '{MERGE_SPLIT}' AS early, CAST(count(*) AS INTEGER) AS demand
FROM clean GROUP BY 1, 2, 3""",
    "clean",
)
_period_sql("early", "mart_a")
_period_sql("NOT early", "mart_b")
O.cte(
    "merged_sum",
    "SELECT timestamp, zone_id, CAST(sum(demand) AS INTEGER) AS demand FROM "
    "(SELECT * FROM mart_a UNION ALL SELECT * FROM mart_b) GROUP BY timestamp, zone_id",
    "mart_a",
    "mart_b",
)


@register(
    "merge_monthly_marts",
    O.with_ctes(
        """
SELECT h.timestamp, z.zone_id, CAST(coalesce(c.demand, 0) AS INTEGER) AS demand
FROM (SELECT unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR)) AS timestamp FROM merged_sum) h
CROSS JOIN (SELECT DISTINCT zone_id FROM merged_sum) z
LEFT JOIN merged_sum c ON c.timestamp = h.timestamp AND c.zone_id = z.zone_id""",
        "merged_sum",
    ),
)
def _merge(spark, sf):
    """Two period marts (before / from the split), each gridded on its own,
    then merged."""
    early = mt.aggregate_hourly_demand(dt.trips(spark, sf, None, MERGE_SPLIT))
    late = mt.aggregate_hourly_demand(dt.trips(spark, sf, MERGE_SPLIT, None))
    return mt.merge_hourly_demand([early, late])


# ---- EDA ----------------------------------------------------------------------------
register(
    "demand_overview",
    O.rounded(
        O.with_ctes(
            """
SELECT count(*) AS rows, count(DISTINCT zone_id) AS zones, min(timestamp) AS start, max(timestamp) AS "end",
       CAST(sum(demand) AS BIGINT) AS total_demand, avg(demand) AS mean_hourly_zone_demand,
       avg(CAST(demand = 0 AS DOUBLE)) AS zero_demand_share
FROM mart""",
            "mart",
        ),
        ["mean_hourly_zone_demand", "zero_demand_share"],
    ),
)(lambda spark, sf: round_doubles(eda.demand_overview(_mart(spark, sf))))

for _name, _key, _fn in (
    ("hourly_profile", "CAST(hour(timestamp) AS INTEGER) AS hour", eda.hourly_profile),
    ("weekday_profile", "CAST(isodow(timestamp) AS INTEGER) AS weekday", eda.weekday_profile),
):
    register(
        _name,
        O.rounded(
            O.with_ctes(
                f"SELECT {_key}, CAST(sum(demand) AS BIGINT) AS total_demand, avg(demand) AS mean_zone_demand, "
                "count(*) AS observations FROM mart GROUP BY 1",
                "mart",
            ),
            ["mean_zone_demand"],
        ),
    )(lambda spark, sf, _fn=_fn: round_doubles(_fn(_mart(spark, sf))))

TOP_SQL = """
SELECT zone_id, CAST(sum(demand) AS BIGINT) AS total_demand, avg(demand) AS mean_hourly_demand
FROM mart GROUP BY zone_id ORDER BY total_demand DESC, zone_id ASC LIMIT 20"""
register("top_zones", O.rounded(O.with_ctes(TOP_SQL, "mart"), ["mean_hourly_demand"]))(
    lambda spark, sf: round_doubles(eda.top_zones(_mart(spark, sf), n=20))
)
register(
    "top_zones_labeled",
    O.rounded(
        O.with_ctes(
            f"SELECT t.*, l.borough, l.zone_name FROM ({TOP_SQL}) t LEFT JOIN zone_lookup l ON t.zone_id = l.zone_id",
            "mart",
            "zone_lookup",
        ),
        ["mean_hourly_demand"],
    ),
)(lambda spark, sf: round_doubles(eda.top_zones(_mart(spark, sf), n=20, zone_lookup=_lookup(spark, sf))))

# ---- scored window: features + direct weekly baseline as the prediction -----------------
O.cte(
    "scored",
    f"""
SELECT * FROM (SELECT f.*, lead(demand, {HORIZON}) OVER ({O.W}) AS actual,
                      CAST(lag(demand, {168 - HORIZON}) OVER ({O.W}) AS DOUBLE) AS prediction,
                      timestamp + INTERVAL {HORIZON} HOUR AS forecast_timestamp
               FROM features f)
WHERE actual IS NOT NULL AND prediction IS NOT NULL""",
    "features",
)
WINDOW_SPLIT = "2024-01-16 00:00:00"
O.cte("ref_window", f"SELECT * FROM scored WHERE timestamp < TIMESTAMP '{WINDOW_SPLIT}'", "scored")
O.cte("cur_window", f"SELECT * FROM scored WHERE timestamp >= TIMESTAMP '{WINDOW_SPLIT}'", "scored")
MONITORED = ("demand_lag_1h", "demand_lag_24h", "demand_lag_168h", "demand_roll_mean_24h", "demand_roll_std_24h", "prediction", "hour")


def _scored(spark, sf):
    return hz.attach_direct_seasonal_baseline(_features(spark, sf), horizon_hours=HORIZON, target_column="actual")


def _windows(spark, sf):
    # both windows and several reports read the scored frame: compute it once
    scored = materialize(_scored(spark, sf))
    split = ntz_literal(WINDOW_SPLIT)
    return scored.filter(F.col("timestamp") < split), scored.filter(F.col("timestamp") >= split)


METRICS4 = ["mae", "rmse", "wape", "smape"]
register(
    "forecast_metrics",
    O.rounded(O.with_ctes(f"SELECT {O.metric_sql('actual', 'prediction')} FROM scored", "scored"), METRICS4),
)(lambda spark, sf: round_doubles(_scored(spark, sf).agg(*M.forecast_metrics("actual", "prediction"))))

RS_COLS = ["bias", "median_absolute_error", "p90_absolute_error", "underprediction_share", "overprediction_share"]
register(
    "residual_summary",
    O.rounded(
        O.with_ctes(
            """
SELECT avg(actual - prediction) AS bias,
       quantile_cont(abs(actual - prediction), 0.5) AS median_absolute_error,
       quantile_cont(abs(actual - prediction), 0.9) AS p90_absolute_error,
       avg(CAST(actual - prediction > 0 AS DOUBLE)) AS underprediction_share,
       avg(CAST(actual - prediction < 0 AS DOUBLE)) AS overprediction_share
FROM scored""",
            "scored",
        ),
        RS_COLS,
    ),
)(lambda spark, sf: round_doubles(dg.residual_summary(_scored(spark, sf))))

register(
    "residual_summary_by_zone",
    O.rounded(
        O.with_ctes(
            """
SELECT zone_id, avg(actual - prediction) AS bias,
       quantile_cont(abs(actual - prediction), 0.5) AS median_absolute_error,
       quantile_cont(abs(actual - prediction), 0.9) AS p90_absolute_error,
       avg(CAST(actual - prediction > 0 AS DOUBLE)) AS underprediction_share,
       avg(CAST(actual - prediction < 0 AS DOUBLE)) AS overprediction_share
FROM scored GROUP BY zone_id""",
            "scored",
        ),
        RS_COLS,
    ),
)(lambda spark, sf: round_doubles(dg.residual_summary(_scored(spark, sf), by=["zone_id"])))

register(
    "error_rows",
    O.rounded(
        O.with_ctes(
            "SELECT timestamp, zone_id, actual, prediction, actual - prediction AS residual, "
            "abs(actual - prediction) AS absolute_error FROM scored",
            "scored",
        ),
        ["prediction", "residual", "absolute_error"],
    ),
)(
    lambda spark, sf: round_doubles(
        dg.error_frame(_scored(spark, sf), actual_column="actual").select(
            "timestamp", "zone_id", "actual", "prediction", "residual", "absolute_error"
        )
    )
)

register(
    "zone_error_table",
    O.rounded(
        O.with_ctes(
            "SELECT zone_id, avg(abs(actual - prediction)) AS mae, avg(actual - prediction) AS bias, "
            "CAST(sum(actual) AS BIGINT) AS actual_demand, count(*) AS observations FROM scored GROUP BY zone_id",
            "scored",
        ),
        ["mae", "bias"],
    ),
)(lambda spark, sf: round_doubles(dg.zone_error_table(_scored(spark, sf), actual_column="actual")))

register(
    "demand_band_errors",
    O.rounded(
        O.with_ctes(
            """
SELECT CASE WHEN actual = 0 THEN 'zero' WHEN actual <= 5 THEN 'low' WHEN actual <= 20 THEN 'medium' ELSE 'high' END AS demand_band,
       avg(abs(actual - prediction)) AS mae, avg(actual - prediction) AS bias, count(*) AS observations
FROM scored GROUP BY 1""",
            "scored",
        ),
        ["mae", "bias"],
    ),
)(lambda spark, sf: round_doubles(dg.demand_band_error_table(_scored(spark, sf), actual_column="actual")))

SNAP_COLS = ["mae", "rmse", "wape", "smape", "bias", "p90_absolute_error"]


def _snapshot_sql(src: str, prefix: str = "") -> str:
    return f"""
SELECT count(*) AS {prefix}observations, {O.metric_sql('actual', 'prediction', prefix)},
       avg(actual - prediction) AS {prefix}bias,
       quantile_cont(abs(actual - prediction), 0.9) AS {prefix}p90_absolute_error
FROM {src} WHERE actual IS NOT NULL AND prediction IS NOT NULL"""


register(
    "performance_snapshot",
    O.rounded(O.with_ctes(_snapshot_sql("scored"), "scored"), SNAP_COLS),
)(lambda spark, sf: round_doubles(mon.performance_snapshot(_scored(spark, sf))))

register(
    "performance_by_day",
    O.rounded(
        O.with_ctes(
            """
SELECT CAST(timestamp AS DATE) AS date, count(*) AS observations, avg(abs(actual - prediction)) AS mae,
       avg(actual - prediction) AS bias,
       CASE WHEN sum(abs(actual)) = 0 THEN 'inf'::DOUBLE ELSE sum(abs(actual - prediction)) / sum(abs(actual)) END AS wape
FROM scored GROUP BY 1""",
            "scored",
        ),
        ["mae", "bias", "wape"],
    ),
)(lambda spark, sf: round_doubles(mon.performance_by_day(_scored(spark, sf))))

O.cte("ref_snap", _snapshot_sql("ref_window", "reference_"), "ref_window")
O.cte("cur_snap", _snapshot_sql("cur_window", "current_"), "cur_window")
REGRESSION_CASE = """CASE WHEN reference_wape = 0 THEN (CASE WHEN current_wape = 0 THEN 'stable' ELSE 'critical' END)
            WHEN current_wape / reference_wape >= 1.30 THEN 'critical'
            WHEN current_wape / reference_wape >= 1.15 THEN 'watch' ELSE 'stable' END"""


@register(
    "performance_regression",
    O.rounded(
        O.with_ctes(
            f"SELECT reference_wape, current_wape, {REGRESSION_CASE} AS status FROM ref_snap, cur_snap",
            "ref_snap",
            "cur_snap",
        ),
        ["reference_wape", "current_wape"],
    ),
)
def _regression(spark, sf):
    ref, cur = _windows(spark, sf)
    tagged = ref.withColumn("w", F.lit("reference")).unionByName(cur.withColumn("w", F.lit("current")))
    wapes = tagged.groupBy().pivot("w", ["reference", "current"]).agg(M.wape("actual", "prediction"))
    wapes = wapes.select(F.col("reference").alias("reference_wape"), F.col("current").alias("current_wape"))
    return round_doubles(
        wapes.withColumn("status", classify_performance_regression("reference_wape", "current_wape"))
    )


def _psi_sql(features) -> str:
    cols = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in features)
    names = ", ".join(features)
    qs = ", ".join(str(i / 10) for i in range(11))
    return f"""
WITH rl AS (SELECT feature, value FROM (UNPIVOT (SELECT {cols} FROM ref_window) ON {names} INTO NAME feature VALUE value) WHERE value IS NOT NULL),
cl AS (SELECT feature, value FROM (UNPIVOT (SELECT {cols} FROM cur_window) ON {names} INTO NAME feature VALUE value) WHERE value IS NOT NULL),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{qs}]))) AS e FROM rl GROUP BY feature),
rn AS (SELECT feature, count(*) AS n FROM rl GROUP BY feature),
cn AS (SELECT feature, count(*) AS n FROM cl GROUP BY feature),
rb AS (SELECT r.feature, len(list_filter(e.e[2:len(e.e) - 1], lambda t: t <= r.value)) AS bin, count(*) AS c
       FROM rl r JOIN edges e USING (feature) GROUP BY 1, 2),
cb AS (SELECT r.feature, len(list_filter(e.e[2:len(e.e) - 1], lambda t: t <= r.value)) AS bin, count(*) AS c
       FROM cl r JOIN edges e USING (feature) GROUP BY 1, 2),
shares AS (SELECT coalesce(rb.feature, cb.feature) AS feature,
                  greatest(coalesce(rb.c, 0) / rn.n, 1e-6) AS es, greatest(coalesce(cb.c, 0) / cn.n, 1e-6) AS os
           FROM rb FULL JOIN cb ON rb.feature = cb.feature AND rb.bin = cb.bin
           JOIN rn ON rn.feature = coalesce(rb.feature, cb.feature)
           JOIN cn ON cn.feature = coalesce(rb.feature, cb.feature)),
psi AS (SELECT s.feature, CASE WHEN len(any_value(ed.e)) < 2 THEN
                 (CASE WHEN (SELECT bool_and(abs(c.value - any_value(ed.e)[1]) <= 1e-8 + 1e-5 * abs(any_value(ed.e)[1]))
                             FROM cl c WHERE c.feature = s.feature)
                       THEN 0.0 ELSE 'inf'::DOUBLE END)
               ELSE sum((s.os - s.es) * ln(s.os / s.es)) END AS psi
        FROM shares s JOIN edges ed ON ed.feature = s.feature GROUP BY s.feature)
SELECT feature, psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'watch' ELSE 'drift' END AS status FROM psi"""


O.cte("psi_table", _psi_sql(MONITORED), "ref_window", "cur_window")
register("psi_drift", O.rounded(O.with_ctes("SELECT * FROM psi_table", "psi_table"), ["psi"]))(
    lambda spark, sf: round_doubles(mon.feature_drift_report(*_windows(spark, sf), feature_names=MONITORED))
)

O.cte(
    "radius",
    """
SELECT 0.9 AS coverage, e AS radius FROM (
  SELECT e, row_number() OVER (ORDER BY e) - 1 AS k, count(*) OVER () AS n
  FROM (SELECT abs(actual - prediction) AS e FROM ref_window))
WHERE k = CAST(ceil(least(ceil((n + 1) * 0.9) / n, 1.0) * (n - 1)) AS BIGINT)""",
    "ref_window",
)
register("conformal_radius", O.rounded(O.with_ctes("SELECT * FROM radius", "radius"), ["coverage", "radius"]))(
    lambda spark, sf: round_doubles(iv.conformal_radius(_windows(spark, sf)[0], coverage=0.9))
)


register(
    "conformal_radius_by_zone",
    O.rounded(
        O.with_ctes(
            """
SELECT zone_id, 0.9 AS coverage, e AS radius FROM (
  SELECT zone_id, e, row_number() OVER (PARTITION BY zone_id ORDER BY e) - 1 AS k, count(*) OVER (PARTITION BY zone_id) AS n
  FROM (SELECT zone_id, abs(actual - prediction) AS e FROM ref_window))
WHERE k = CAST(ceil(least(ceil((n + 1) * 0.9) / n, 1.0) * (n - 1)) AS BIGINT)""",
            "ref_window",
        ),
        ["coverage", "radius"],
    ),
)(lambda spark, sf: round_doubles(iv.conformal_radius(_windows(spark, sf)[0], coverage=0.9, by=["zone_id"])))


@register(
    "conformal_bounds",
    O.rounded(
        O.with_ctes(
            "SELECT c.timestamp, c.zone_id, c.actual, c.prediction, greatest(c.prediction - r.radius, 0.0) AS lower, "
            "c.prediction + r.radius AS upper FROM cur_window c CROSS JOIN radius r",
            "cur_window",
            "radius",
            once=True,
        ),
        ["prediction", "lower", "upper"],
    ),
)
def _bounds(spark, sf):
    ref, cur = _windows(spark, sf)
    radius = iv.conformal_radius(ref, coverage=0.9).select(F.col("radius")).scalar()
    out = cur.select("timestamp", "zone_id", "actual", "prediction").withColumns(iv.conformal_bounds("prediction", radius))
    return round_doubles(out)


SAMPLE_ROWS = 500
register(
    "even_sample",
    O.rounded(
        O.with_ctes(
            f"""
SELECT * EXCLUDE (i) FROM (SELECT *, row_number() OVER (ORDER BY timestamp, zone_id) - 1 AS i FROM features)
WHERE i IN (SELECT CASE WHEN j = {SAMPLE_ROWS} - 1 THEN n - 1
                        ELSE CAST(floor(j * (CAST(n - 1 AS DOUBLE) / {SAMPLE_ROWS - 1})) AS BIGINT) END
            FROM range({SAMPLE_ROWS}) r(j), (SELECT count(*) AS n FROM features))""",
            "features",
        ),
        O.ROLL_COLUMNS,
    ),
)(lambda spark, sf: round_doubles(smp.even_sample(_features(spark, sf), SAMPLE_ROWS)))


MON_COLS = [f"{w}_{m}" for w in ("reference", "current") for m in SNAP_COLS] + ["max_psi"]
register(
    "monitoring_report",
    O.rounded(
        O.with_ctes(
            f"""
SELECT CASE WHEN perf = 'critical' OR drift_features > 0 THEN 'critical'
            WHEN perf = 'watch' OR watch_features > 0 THEN 'watch' ELSE 'stable' END AS overall_status,
       perf AS performance_status, * EXCLUDE (perf)
FROM (SELECT {REGRESSION_CASE} AS perf, *,
             (SELECT max(psi) FROM psi_table) AS max_psi,
             (SELECT count(*) FROM psi_table WHERE status = 'drift') AS drift_features,
             (SELECT count(*) FROM psi_table WHERE status = 'watch') AS watch_features
      FROM ref_snap, cur_snap)""",
            "ref_snap",
            "cur_snap",
            "psi_table",
        ),
        MON_COLS,
    ),
)(lambda spark, sf: round_doubles(mon.monitoring_report(*_windows(spark, sf), feature_names=MONITORED)))


# ---- build manifest -------------------------------------------------------------------
from zonecast.plans import build as bd  # noqa: E402

BUILD_START, BUILD_END = "2024-01", "2024-01"
O.cte(
    "tflags",
    "SELECT *, strftime(tpep_pickup_datetime, '%Y-%m') AS month FROM flags "
    "WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-01' AND tpep_pickup_datetime < TIMESTAMP '2024-02-01'",
    "flags",
)
O.cte(
    "tcounts",
    "SELECT date_trunc('hour', tpep_pickup_datetime) AS timestamp, CAST(PULocationID AS SMALLINT) AS zone_id, count(*) AS demand "
    "FROM tflags WHERE NOT (null_pickup OR invalid_zone OR invalid_duration OR invalid_distance) GROUP BY 1, 2",
    "tflags",
)
register(
    "build_manifest",
    O.rounded(
        O.with_ctes(
            f"""
SELECT month, count(*) AS input_rows,
       count(*) FILTER (WHERE NOT (null_pickup OR invalid_zone OR invalid_duration OR invalid_distance)) AS valid_rows,
       count(*) FILTER (WHERE null_pickup OR invalid_zone OR invalid_duration OR invalid_distance) AS dropped_rows,
       count(*) FILTER (WHERE null_pickup) AS null_pickup_rows,
       count(*) FILTER (WHERE invalid_zone) AS invalid_zone_rows,
       count(*) FILTER (WHERE invalid_duration) AS invalid_duration_rows,
       count(*) FILTER (WHERE invalid_distance) AS invalid_distance_rows,
       count(*) FILTER (WHERE NOT (null_pickup OR invalid_zone OR invalid_duration OR invalid_distance)) / count(*) AS valid_share,
       '{BUILD_START}' AS start_month, '{BUILD_END}' AS end_month,
       (SELECT count(DISTINCT zone_id) * (date_diff('hour', min(timestamp), max(timestamp)) + 1) FROM tcounts) AS merged_rows,
       (SELECT count(DISTINCT zone_id) FROM tcounts) AS merged_zones
FROM tflags GROUP BY month""",
            "tflags",
            "tcounts",
        ),
        ["valid_share"],
    ),
)(
    lambda spark, sf: round_doubles(
        bd.build_manifest(_trips(spark, sf), BUILD_START, BUILD_END)[1]
    )
)

O.cte(
    "tgrid",
    """
SELECT h.timestamp, z.zone_id, CAST(coalesce(c.demand, 0) AS INTEGER) AS demand
FROM (SELECT unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR)) AS timestamp FROM tcounts) h
CROSS JOIN (SELECT DISTINCT zone_id FROM tcounts) z
LEFT JOIN tcounts c ON c.timestamp = h.timestamp AND c.zone_id = z.zone_id""",
    "tcounts",
)


@register("month_update", O.with_ctes("SELECT strftime(timestamp, '%Y-%m') AS month, * FROM tgrid", "tgrid", once=True))
def _month_update(spark, sf):
    """The month is built from its first half, then brought up to date."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/zonecast-tables/build-{uuid.uuid4().hex}"
    bd.build_dataset_range(dt.trips(spark, sf, None, MERGE_SPLIT), BUILD_START, BUILD_END, folder)
    bd.update_months(_trips(spark, sf), [BUILD_END], folder)
    return spark.read.parquet(f"{folder}/demand").select(F.col("month").cast("string"), "timestamp", "zone_id", "demand")


# ---- fitted models (rows-only where SQL cannot fit them, identities where it can check them) ----
from zonecast.plans import models as md  # noqa: E402

MODEL_SPLIT = "2024-01-21 00:00:00"


def _model_frames(spark, sf):
    supervised = materialize(hz.make_horizon_dataset(_features(spark, sf), horizon_hours=HORIZON))
    split = ntz_literal(MODEL_SPLIT)
    train = supervised.filter((F.col("timestamp") < split) & (F.col("forecast_timestamp") < split))
    score = md.complete_cases(supervised.filter(F.col("timestamp") >= split),
                              [c for c in supervised.columns if c not in ("target_demand",)])
    return train, score


def _fitted(spark, sf):
    train, score = _model_frames(spark, sf)
    features = md.infer_feature_columns(train)
    return md.train_model(train, feature_columns=features, target_column="target_demand", horizon_hours=HORIZON), score


@register("train_score_poisson")
def _train_score(spark, sf):
    model, score = _fitted(spark, sf)
    return model.predict(score).select("timestamp", "zone_id", "target_demand", "prediction")


@register("feature_importance")
def _importance(spark, sf):
    return md.feature_importance_frame(_fitted(spark, sf)[0])


def _fitted_trees(spark, sf):
    train, score = _model_frames(spark, sf)
    model = md.train_model(train, target_column="target_demand", kind="poisson_trees", params=TREE_PARAMS, horizon_hours=HORIZON)
    return model, score


TREE_PARAMS = {"rounds": 12, "max_depth": 4, "learning_rate": 0.3, "bins": 32}


@register("train_score_poisson_trees")
def _train_score_trees(spark, sf):
    model, score = _fitted_trees(spark, sf)
    return model.predict(score).select("timestamp", "zone_id", "target_demand", "prediction")


@register("tree_split_counts")
def _tree_splits(spark, sf):
    return md.split_counts(_fitted_trees(spark, sf)[0])


@register("tree_global_contributions")
def _tree_global(spark, sf):
    model, score = _fitted_trees(spark, sf)
    return md.global_contributions(model, score)


O.cte(
    "supervised",
    f"SELECT * FROM (SELECT f.*, lead(demand, {HORIZON}) OVER ({O.W}) AS target_demand, "
    f"timestamp + INTERVAL {HORIZON} HOUR AS forecast_timestamp FROM features f) WHERE target_demand IS NOT NULL",
    "features",
)
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in ("demand_lag_168h", *O.ROLL_COLUMNS))


@register(
    "contribution_identity",
    O.with_ctes(
        f"SELECT kind, count(*) AS scored, CAST(0 AS BIGINT) AS unexplained FROM supervised, (VALUES ('poisson_glm'), ('poisson_trees')) AS k(kind) "
        f"WHERE timestamp >= TIMESTAMP '{MODEL_SPLIT}' AND {COMPLETE} GROUP BY kind",
        "supervised",
    ),
)
def _contribution_identity(spark, sf):
    """For both kinds of model: in how many of the scored rows base and
    contributions do not add up to the logarithm of the prediction."""
    parts = []
    for kind, (model, score) in (("poisson_glm", _fitted(spark, sf)), ("poisson_trees", _fitted_trees(spark, sf))):
        told = md.local_contributions(model, score).select("timestamp", "zone_id", "explained_value")
        both = model.predict(score).select("timestamp", "zone_id", "prediction").join(told, ["timestamp", "zone_id"])
        off = F.abs(F.ln("prediction") - F.col("explained_value")) > 1e-6
        parts.append(both.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("scored"), F.count_if(off).alias("unexplained")))
    return parts[0].unionByName(parts[1])


O.fold_ctes("supervised", TRAIN_DAYS, VALIDATION_DAYS, STEP_DAYS, "sfolds")


@register(
    "glm_fold_totals",
    O.with_ctes(
        f"""
SELECT f.fold, count(*) AS train_rows, CAST(sum(s.target_demand) AS BIGINT) AS target_total, TRUE AS balanced
FROM supervised s JOIN sfolds f ON s.timestamp >= f.train_start AND s.timestamp < f.train_end AND s.forecast_timestamp < f.validation_start
WHERE {COMPLETE} GROUP BY f.fold""",
        "supervised",
        "sfolds",
        once=True,
    ),
)
def _glm_fold_totals(spark, sf):
    """The fits of all folds: at the maximum of the likelihood the fitted rates
    of a fold's training rows add up to its targets."""
    supervised = materialize(hz.make_horizon_dataset(_features(spark, sf), horizon_hours=HORIZON))
    plan = _fold_plan(supervised)
    features = md.infer_feature_columns(supervised)
    clean = md.complete_cases(supervised, [*features, "target_demand"]).withColumn("first", plan.first_training_fold()).filter(F.col("first") <= plan.count)
    design = [md.design_column(f) for f in features]
    blocks = fg.design_blocks(clean, design, "target_demand", "first")
    models = fg.fit_folds(blocks, len(design), range(1, plan.count + 1), [1e-4])
    rows = clean.withColumn("fold", F.explode(F.sequence("first", F.lit(plan.count))))
    rate = fg.score_column({f: m for (f, _), m in models.items()}, design, "fold")
    totals = rows.select("fold", "target_demand", rate.alias("rate")).groupBy("fold").agg(
        F.count(F.lit(1)).alias("train_rows"), F.sum("target_demand").alias("target_total"), F.sum("rate").alias("fitted")
    )
    balanced = F.abs(F.col("fitted") - F.col("target_total")) <= 1e-5 * F.col("target_total")
    return totals.select(F.col("fold").cast("int").alias("fold"), "train_rows", "target_total", balanced.alias("balanced"))


@register("batch_forecast")
def _batch(spark, sf):
    model, score = _fitted(spark, sf)
    ids = ["timestamp", "zone_id"]
    return md.batch_forecast(score.select(*ids, *[f for f in model.feature_names if f not in ids]), model)


@register("global_contributions")
def _global_contrib(spark, sf):
    model, score = _fitted(spark, sf)
    return md.global_contributions(model, score)


@register("local_contributions")
def _local_contrib(spark, sf):
    model, score = _fitted(spark, sf)
    return md.local_contributions(model, score).select(
        "timestamp", "zone_id", "base_value", "explained_value", F.to_json("contributions").alias("contributions")
    )


register("model_backtest")(
    lambda spark, sf: bt.backtest_model(
        _features(spark, sf), horizon_hours=HORIZON, train_days=TRAIN_DAYS,
        validation_days=VALIDATION_DAYS, step_days=STEP_DAYS,
    )
)


def _model_vs_baseline(spark, sf):
    return bt.compare_model_to_seasonal_baseline(
        _features(spark, sf), horizon_hours=HORIZON, train_days=TRAIN_DAYS,
        validation_days=VALIDATION_DAYS, step_days=STEP_DAYS,
    )


register("model_vs_baseline")(_model_vs_baseline)
register("benchmark_summary")(lambda spark, sf: bt.summarize_benchmark(_model_vs_baseline(spark, sf)))
register("param_search")(
    lambda spark, sf: bt.search_parameters(
        _features(spark, sf), horizon_hours=HORIZON, train_days=TRAIN_DAYS,
        validation_days=VALIDATION_DAYS, step_days=STEP_DAYS, n_trials=3,
    )
)


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
