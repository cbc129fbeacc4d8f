"""Exact ranks and quantiles of many groups against NumPy."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import scored_df
from zonecast.functions import selection as sel
from zonecast.operators import diagnostics as dg
from zonecast.operators import intervals as iv
from zonecast.operators import monitoring as mon


def groups():
    rng = np.random.default_rng(21)
    return {
        "normal": rng.normal(0, 1, 2000), "ties": rng.integers(0, 5, 900).astype(float), "one": np.array([7.0]), "same": np.full(50, -2.5),
        "wide": np.array([-1.7e308, -1.0, 0.0, 1e-300, 5e-324, 1.0, 1.7e308]), "tiny": np.array([0.0, 5e-324, 1e-323, 1.5e-323]),
        "skew": np.exp(rng.normal(0, 8, 1500)), "signed zero": np.array([-0.0, 0.0, -1.0]),
    }


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(g, float(x), 1 + i % 3) for g, xs in groups().items() for i, x in enumerate(xs)]
    rows += [("normal", None, 5), (None, 3.0, 1), (None, 4.0, 1)]
    return spark.createDataFrame(rows, "g string, x double, w long").repartition(5).cache()


@pytest.mark.parametrize("buckets", [2, 7, 1024])
def test_ranks_of_all_groups_together(frame, buckets):
    asked = {(g,): sorted({0, len(x) // 3, len(x) // 2, len(x) - 1}) for g, x in groups().items()} | {(None,): [0, 1]}
    found = sel.select_ranks(frame, "x", asked, by=["g"], buckets=buckets)
    for g, xs in groups().items():
        ordered = np.sort(xs)
        assert found[(g,)] == {k: ordered[k] for k in asked[(g,)]}
    assert found[(None,)] == {0: 3.0, 1: 4.0}
    with pytest.raises(ValueError):
        sel.select_ranks(frame, "x", {("one",): [1]}, by=["g"])


def test_weighted_quantiles(frame):
    steps = [0.0, 0.1, 0.25, 0.5, 0.77, 0.9, 1.0]
    found = sel.quantile_table(frame, "x", steps, by=["g"], weight="w")
    for g, xs in groups().items():
        if g == "wide":
            continue  # NumPy overflows between the two largest
        repeated = np.repeat(xs, [1 + i % 3 for i in range(len(xs))])
        assert found[(g,)] == pytest.approx(np.quantile(repeated, steps).tolist(), rel=1e-12, abs=1e-320)


def test_quantile_frames_of_nothing(spark, frame):
    empty = frame.where("false")
    assert sel.quantile_frame(empty, "x", [0.5], by=["g"]).count() == 0
    assert [tuple(r) for r in sel.quantile_frame(empty, "x", [0.5]).collect()] == [(None,)]


def test_what_a_pass_returns_is_bounded(frame, monkeypatch):
    """Rows to the driver: buckets of the open ranges, never distinct values."""
    seen = []
    real = sel._histogram

    def watched(data, by, open_, buckets):
        out = real(data, by, open_, buckets)
        seen.append((out.count(), len(open_) * buckets))
        return out

    monkeypatch.setattr(sel, "_histogram", watched)
    monkeypatch.setattr(sel, "PASS_ROWS", 64)
    steps = [i / 10 for i in range(11)]
    found = sel.quantile_table(frame, "x", steps, by=["g"])
    assert found[("normal",)] == pytest.approx(np.quantile(groups()["normal"], steps).tolist())
    assert seen and all(rows <= bound for rows, bound in seen) and all(rows <= 128 for rows, _ in seen)


def test_ten_features_of_many_distinct_values(spark):
    n = 200_000
    cols = [(F.sin(F.col("id") * (k + 1)) * F.pow(F.lit(10.0), F.lit(k - 5))).alias(f"f{k}") for k in range(10)]
    data = spark.range(n).select(*cols)
    steps = [i / 10 for i in range(11)]
    long = data.unpivot([], [f"f{k}" for k in range(10)], "feature", "value")
    found = sel.quantile_table(long, "value", steps, by=["feature"])
    for k, column in enumerate(data.toPandas().columns):
        want = np.quantile(np.sin(np.arange(n) * (k + 1)) * 10.0 ** (k - 5), steps)
        assert np.allclose(found[(column,)], want, rtol=1e-9, atol=0)


def test_grouped_radius_and_summaries(spark):
    rng = np.random.default_rng(2)
    a, p = rng.integers(0, 30, 600).astype(float), rng.normal(10, 5, 600)
    frame = scored_df(spark, a, p).withColumn("zone", F.when(F.col("prediction") < 8, 1).when(F.col("prediction") < 12, 2))
    zone = np.where(p < 8, 1, np.where(p < 12, 2, 0))
    radius = {r.zone or 0: r.radius for r in iv.conformal_radius(frame, coverage=0.8, by=["zone"]).collect()}
    table = {r.zone or 0: r for r in dg.residual_summary(frame, by=["zone"]).collect()}
    snaps = {r.zone or 0: r for r in mon.performance_snapshot(frame, by=["zone"]).collect()}
    for z in (0, 1, 2):
        errors = np.abs(a - p)[zone == z]
        level = min(math.ceil((len(errors) + 1) * 0.8) / len(errors), 1.0)
        assert radius[z] == np.quantile(errors, level, method="higher")
        assert [table[z].median_absolute_error, table[z].p90_absolute_error] == pytest.approx(np.quantile(errors, [0.5, 0.9]).tolist())
        assert snaps[z].p90_absolute_error == pytest.approx(np.quantile(errors, 0.9)) and snaps[z].observations == len(errors)
    with pytest.raises(ValueError, match="finite"):
        iv.conformal_radius(scored_df(spark, [1.0, float("nan")], [1.0, 2.0]))
    with pytest.raises(ValueError, match="rows"):
        iv.conformal_radius(frame.limit(0))
    with pytest.raises(Exception, match="finite"):
        dg.residual_summary(scored_df(spark, [1.0, float("inf")], [1.0, 2.0])).collect()
    with pytest.raises(Exception, match="finite"):
        mon.population_stability(scored_df(spark, [1.0, float("inf")], [1.0, 2.0]), frame, ["actual"]).collect()


def test_no_group_is_sorted_in_one_task(spark):
    frame = scored_df(spark, [1.0, 2.0, 5.0], [1.5, 1.0, 1.0])
    for out in (dg.residual_summary(frame), mon.performance_snapshot(frame), mon.population_stability(frame, frame, ["actual"])):
        assert "percentile(" not in out._jdf.queryExecution().toString()
