"""DuckDB SQL twins of the registered queries (used only as an oracle).

The driver registers every table as a view; these strings re-derive the
same trips view, mart, features and reports with plain SQL windows and
joins, written independently of the DataFrame code. Doubles are rounded
to 6 places at the output edge on both sides.
"""
from __future__ import annotations

from zonecast.schemas import DEFAULT_LAGS, DEFAULT_WINDOWS
from zonecast.sources.driver_tables import TRIPS_SQL, ZONE_LOOKUP_RAW_SQL

# ordered CTE catalogue: name -> (sql, dependencies)
_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    _CTES[name] = (sql, deps)


def _resolve(names, seen, order):
    for name in names:
        if name in seen:
            continue
        sql, deps = _CTES[name]
        _resolve(deps, seen, order)
        seen.add(name)
        order.append(name)


def with_ctes(body: str, *deps: str, once: bool = False) -> str:
    """``body`` after the named tables and all they need; with ``once`` each of
    them is computed a single time, however often it is named."""
    order: list[str] = []
    _resolve(deps, set(), order)
    if not order:
        return body
    how = "AS MATERIALIZED" if once else "AS"
    parts = ",\n".join(f"{name} {how} (\n{_CTES[name][0].strip()}\n)" for name in order)
    return f"WITH {parts}\n{body}"


def rounded(sql: str, columns, places: int = 6) -> str:
    repl = ", ".join(f"round({c}, {places}) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"


cte("trips", TRIPS_SQL)
cte(
    "flags",
    """
SELECT *,
  (tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL) AS null_pickup,
  (PULocationID IS NULL OR NOT (PULocationID BETWEEN 1 AND 265)) AS invalid_zone,
  (tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL
     OR trunc(date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 1000000.0) / 3600.0 < 0
     OR trunc(date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 1000000.0) / 3600.0 > 8.0)
     AS invalid_duration,
  (trip_distance IS NULL OR NOT (trip_distance BETWEEN 0.0 AND 200.0)) AS invalid_distance
FROM trips
""",
    "trips",
)
cte(
    "clean",
    """
SELECT tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID, trip_distance, total_amount
FROM flags WHERE NOT (null_pickup OR invalid_zone OR invalid_duration OR invalid_distance)
""",
    "flags",
)
cte(
    "counts",
    """
SELECT date_trunc('hour', tpep_pickup_datetime) AS timestamp,
       CAST(PULocationID AS SMALLINT) AS zone_id,
       CAST(count(*) AS INTEGER) AS demand
FROM clean GROUP BY 1, 2
""",
    "clean",
)
cte("bounds", "SELECT min(timestamp) AS lo, max(timestamp) AS hi FROM counts", "counts")
cte("hours", "SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS timestamp FROM bounds", "bounds")
cte("zones", "SELECT DISTINCT zone_id FROM counts", "counts")
cte(
    "mart",
    """
SELECT h.timestamp, z.zone_id, CAST(coalesce(c.demand, 0) AS INTEGER) AS demand
FROM hours h CROSS JOIN zones z
LEFT JOIN counts c ON c.timestamp = h.timestamp AND c.zone_id = z.zone_id
""",
    "hours",
    "zones",
    "counts",
)

W = "PARTITION BY zone_id ORDER BY timestamp"


def _calendar_sql() -> str:
    return (
        "CAST(hour(timestamp) AS TINYINT) AS hour, "
        "CAST(isodow(timestamp) AS TINYINT) AS day_of_week, "
        "CAST(day(timestamp) AS TINYINT) AS day_of_month, "
        "CAST(month(timestamp) AS TINYINT) AS month, "
        "CAST(isodow(timestamp) >= 6 AS TINYINT) AS is_weekend"
    )


def _lags_sql(lags=DEFAULT_LAGS) -> str:
    return ", ".join(f"lag(demand, {k}) OVER ({W}) AS demand_lag_{k}h" for k in lags)


def _rolling_sql(windows=DEFAULT_WINDOWS) -> str:
    """Shifted rolling mean and sample std.

    The std is written as sqrt((n*sum(x^2) - sum(x)^2) / (n*(n-1))) over
    exact integer window sums instead of ``stddev_samp``: the latter's
    streaming updates differ from the exact value in the last bits, and
    PSI bin edges (quantiles of these values) are sensitive to single ulps.
    """
    parts = []
    for w in windows:
        frame = f"OVER ({W} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        n, s1, s2 = f"count(demand) {frame}", f"sum(demand) {frame}", f"sum(CAST(demand AS BIGINT) * demand) {frame}"
        parts.append(f"avg(demand) {frame} AS demand_roll_mean_{w}h")
        parts.append(
            f"CASE WHEN {n} >= 2 THEN sqrt(greatest(CAST({n} * {s2} - {s1} * {s1} AS DOUBLE) "
            f"/ CAST({n} * ({n} - 1) AS DOUBLE), 0.0)) END AS demand_roll_std_{w}h"
        )
    return ", ".join(parts)


ROLL_COLUMNS = [f"demand_roll_{s}_{w}h" for w in DEFAULT_WINDOWS for s in ("mean", "std")]

cte(
    "features",
    f"SELECT timestamp, zone_id, demand, {_calendar_sql()}, {_lags_sql()}, {_rolling_sql()} FROM mart",
    "mart",
)

cte("zone_raw", ZONE_LOOKUP_RAW_SQL)
cte(
    "zone_lookup",
    """
SELECT CAST(LocationID AS SMALLINT) AS zone_id, trim(Borough) AS borough, trim(Zone) AS zone_name,
       trim(coalesce(service_zone, 'Unknown')) AS service_zone
FROM zone_raw
""",
    "zone_raw",
)


def baseline_ctes(h: int, season: int = 168, prefix: str = "b") -> None:
    cte(
        f"{prefix}sup{h}",
        f"""
SELECT timestamp, zone_id, demand,
  lead(demand, {h}) OVER ({W}) AS target_demand,
  CAST(lag(demand, {season - h}) OVER ({W}) AS DOUBLE) AS prediction,
  timestamp + INTERVAL {h} HOUR AS forecast_timestamp
FROM mart
""",
        "mart",
    )
    cte(
        f"{prefix}base{h}",
        f"SELECT * FROM {prefix}sup{h} WHERE target_demand IS NOT NULL AND prediction IS NOT NULL",
        f"{prefix}sup{h}",
    )


def fold_ctes(source: str, train: int, val: int, step: int, name: str) -> None:
    cte(
        name,
        f"""
SELECT CAST(row_number() OVER (ORDER BY vs) AS INTEGER) AS fold, origin AS train_start, vs AS train_end,
       vs AS validation_start, vs + INTERVAL {val} DAY AS validation_end
FROM (SELECT origin, unnest(generate_series(origin + INTERVAL {train} DAY,
                                            last + INTERVAL 1 HOUR - INTERVAL {val} DAY,
                                            INTERVAL {step} DAY)) AS vs
      FROM (SELECT min(timestamp) AS origin, max(timestamp) AS last FROM {source}))
""",
        source,
    )


def metric_sql(a: str = "a", p: str = "p", prefix: str = "") -> str:
    return f"""
  avg(abs({a} - {p})) AS {prefix}mae,
  sqrt(avg(({a} - {p}) * ({a} - {p}))) AS {prefix}rmse,
  CASE WHEN sum(abs({a})) = 0
       THEN CASE WHEN bool_and(abs({a} - {p}) <= 1e-8 + 1e-5 * abs({p})) THEN 0.0 ELSE 'inf'::DOUBLE END
       ELSE sum(abs({a} - {p})) / sum(abs({a})) END AS {prefix}wape,
  avg(CASE WHEN abs({a}) + abs({p}) = 0 THEN 0.0 ELSE 2.0 * abs({a} - {p}) / (abs({a}) + abs({p})) END) AS {prefix}smape"""
