"""Registered queries vs their DuckDB oracles on the smallest driver data."""
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FAST = [
    "quality_report", "clean_trips", "hourly_demand_grid", "build_features", "direct_seasonal_baseline",
    "expanding_folds", "fold_rows", "baseline_backtest", "zone_one_hots", "merge_monthly_marts", "top_zones_labeled",
    "residual_summary", "performance_by_day", "psi_drift", "conformal_radius", "even_sample", "monitoring_report",
    "build_manifest",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "nation", "region"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


def _norm(v):
    if v is None or (not isinstance(v, str) and pd.isna(v)):
        return None
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, float) and math.isfinite(v) and v == int(v):
        return int(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    spark_rows = pd.DataFrame([r.asDict() for r in sdf.collect()], columns=sdf.columns)
    oracle = con.execute(E.oracle_sql()[name]).df()
    assert _rows(spark_rows) == _rows(oracle)


def test_every_query_has_callable_and_entry_runs(spark):
    assert set(E.oracle_sql()).issubset(E.queries())
    out = E.entry(spark)
    assert out.columns[:2] == ["fold", "horizon_hours"]
    assert out.count() >= 1
