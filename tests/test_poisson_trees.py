"""Boosted Poisson trees and their Shapley values against plain versions."""
import itertools
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.plans import models as md
from zonecast.plans import poisson_trees as pt

FEATURES = ("hour", "lag", "zone", "flat")
PARAMS = {"rounds": 6, "max_depth": 3, "min_rows": 5, "learning_rate": 0.3, "bins": 16}


def table(n=1500):
    rng = np.random.default_rng(31)
    hour, lag, zone = rng.integers(0, 24, n), rng.exponential(4, n).round(2), rng.integers(1, 6, n)
    rate = np.exp(0.3 + 0.9 * (hour > 16) + 0.12 * lag - 0.5 * (zone == 3))
    return np.column_stack([hour, lag, zone, np.full(n, 2.0)]).astype(float), rng.poisson(rate).astype(float)


@pytest.fixture(scope="module")
def frame(spark):
    x, y = table()
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, hour double, lag double, zone double, flat double, demand double").repartition(4).cache()


@pytest.fixture(scope="module")
def forest(frame):
    return pt.train_forest(frame, FEATURES, "demand", PARAMS)


def plain_forest(x, y, rounds, max_depth, min_rows, learning_rate, bins, l2=1.0):
    """The same boosting on one machine, a node's rows at a time."""
    cuts = [np.unique(np.quantile(x[:, f], [i / bins for i in range(1, bins)])) for f in range(x.shape[1])]
    base = math.log(y.mean())
    raw = np.full(len(y), base)
    for _ in range(rounds):
        rate = np.exp(raw)
        step = np.zeros(len(y))

        def grow(rows, depth):
            g, h = (y - rate)[rows].sum(), rate[rows].sum()
            best = (1e-12, None)
            if depth < max_depth:
                for f in range(x.shape[1]):
                    for cut in cuts[f]:
                        low = rows[x[rows, f] <= cut]
                        high = rows[x[rows, f] > cut]
                        if min(len(low), len(high)) >= min_rows:
                            score = lambda r: (y - rate)[r].sum() ** 2 / (rate[r].sum() + l2)
                            gain = score(low) + score(high) - g**2 / (h + l2)
                            if gain > best[0] + 1e-9:
                                best = (gain, (low, high))
            if best[1] is None:
                step[rows] = learning_rate * g / (h + l2)
            else:
                for part in best[1]:
                    grow(part, depth + 1)

        grow(np.arange(len(y)), 0)
        raw += step
    return raw


def test_trees_equal_the_plain_boosting(forest):
    x, y = table()
    want = plain_forest(x, y, **PARAMS)
    assert np.allclose(forest.base + forest.raw(x), want, atol=1e-9)


def test_deviance_falls_in_every_round(forest):
    x, y = table()
    assert len(forest.losses) == PARAMS["rounds"] + 1 and all(a > b for a, b in zip(forest.losses, forest.losses[1:]))
    assert forest.losses[-1] == pytest.approx(pt.deviance(y, np.exp(forest.base + forest.raw(x))) / len(y))
    assert forest.losses[0] == pytest.approx(pt.deviance(y, np.full(len(y), y.mean())) / len(y))


def test_written_scores_change_nothing(frame, forest, monkeypatch):
    monkeypatch.setattr(pt, "WRITE_EVERY", 2)
    monkeypatch.setattr(pt, "BLOCK_ROWS", 100)
    again = pt.train_forest(frame, FEATURES, "demand", PARAMS)
    assert [t.feature for t in again.trees] == [t.feature for t in forest.trees]
    assert [v for t in again.trees for v in t.value] == pytest.approx([v for t in forest.trees for v in t.value])


def test_shares_of_rows_and_features(frame):
    options = {**PARAMS, "row_share": 0.6, "feature_share": 0.5}
    one, two = (pt.train_forest(frame, FEATURES, "demand", options) for _ in range(2))
    assert one.to_json() == two.to_json()
    assert 0.5 * 1500 < one.trees[0].rows[0] < 0.7 * 1500
    assert all(len({f for f in t.feature if f >= 0}) <= 2 for t in one.trees)


def test_leaves_and_penalties(frame, forest):
    few = pt.train_forest(frame, FEATURES, "demand", {**PARAMS, "max_leaves": 3})
    assert max(t.feature.count(-1) for t in forest.trees) > 3 == max(t.feature.count(-1) for t in few.trees)
    assert few.trees[0].gain[0] == forest.trees[0].gain[0]
    shrunk = pt.train_forest(frame, FEATURES, "demand", {**PARAMS, "rounds": 1, "l1": 40.0})
    leaf = lambda f: np.abs([v for v, k in zip(f.trees[0].value, f.trees[0].feature) if k < 0])
    assert leaf(shrunk).max() < leaf(forest).max()
    assert pt.train_forest(frame, FEATURES, "demand", {**PARAMS, "l1": 1e9}).trees == []


def test_constant_target_and_bad_parameters(frame):
    flat = pt.train_forest(frame.withColumn("demand", F.lit(3.0)), FEATURES, "demand", PARAMS)
    assert flat.trees == [] and math.exp(flat.base) == pytest.approx(3.0)
    zero = pt.train_forest(frame.withColumn("demand", F.lit(0.0)), FEATURES, "demand", PARAMS)
    assert math.exp(zero.base) < 1e-9
    for bad in ({"bins": 1}, {"leaves": 3}, {"max_depth": 0}):
        with pytest.raises(ValueError):
            pt.train_forest(frame, FEATURES, "demand", bad)
    with pytest.raises(ValueError, match="lacks"):
        pt.train_forest(frame.limit(0), FEATURES, "demand", PARAMS)


def plain_shapley(forest, row):
    """Sum over all subsets of features; a feature outside is averaged over
    the two sides of a node by their cover."""
    def value(inside):
        total = forest.base
        for tree in forest.trees:
            def walk(node):
                f = tree.feature[node]
                if f < 0:
                    return tree.value[node]
                left, right = tree.left[node], tree.right[node]
                if f in inside:
                    return walk(left if row[f] <= tree.threshold[node] else right)
                a, b = tree.cover[left], tree.cover[right]
                return (a * walk(left) + b * walk(right)) / (a + b)
            total += walk(0)
        return total

    m = len(forest.features)
    out = []
    for i in range(m):
        others = [j for j in range(m) if j != i]
        out.append(sum(
            math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) * (value({*s, i}) - value(set(s)))
            for k in range(m) for s in itertools.combinations(others, k)
        ))
    return value(set()), out


def test_contributions_equal_all_subsets(forest):
    x, _ = table()
    told = forest.explanation()
    phi = told.values(x[:12])
    for row, got in zip(x[:12], phi):
        base, want = plain_shapley(forest, row)
        assert told.expected == pytest.approx(base) and got.tolist() == pytest.approx(want, abs=1e-10)
    assert np.allclose(told.expected + told.values(x).sum(axis=1), forest.base + forest.raw(x))
    assert np.abs(told.values(x)[:, 3]).max() == 0.0  # a feature that no split asks for


def test_model_of_the_kind_trees(spark, frame, tmp_dir):
    model = md.train_model(frame, feature_columns=FEATURES, kind="poisson_trees", params=PARAMS, horizon_hours=6)
    rows = {r.id: r for r in model.predict(frame).collect()}
    x, y = table()
    raw = model.forest.base + model.forest.raw(x)
    assert [rows[i].prediction for i in range(len(y))] == pytest.approx(np.exp(raw).tolist())
    assert set(frame.columns) < set(model.predict(frame).columns)
    local = {r.id: r for r in md.local_contributions(model, frame, keys=["id"]).collect()}
    assert [local[i].explained_value for i in range(len(y))] == pytest.approx(raw.tolist())
    glob = {r.feature: r for r in md.global_contributions(model, frame).collect()}
    want = np.abs(model.forest.explanation().values(x)).mean(axis=0)
    assert [glob[f].mean_abs_contribution for f in FEATURES] == pytest.approx(want.tolist())
    counts = {r.feature: r.splits for r in md.split_counts(model).collect()}
    assert counts == {f: sum(t.feature.count(i) for t in model.forest.trees) for i, f in enumerate(FEATURES)}
    assert dict(model.feature_importance()) == counts and counts["flat"] == 0 < counts["hour"]
    model.save(tmp_dir)
    loaded = md.load_model_bundle(tmp_dir)
    assert loaded.forest.to_json() == model.forest.to_json() and loaded.kind == "poisson_trees"
    with pytest.raises(Exception, match="null"):
        loaded.predict(frame.withColumn("lag", F.lit(None).cast("double"))).collect()
    nodes = model.forest.node_table(spark)
    leaves = nodes.filter("feature IS NULL").groupBy("tree").agg(F.sum("rows").alias("n")).collect()
    assert all(r.n == len(y) for r in leaves)


def test_split_counts_of_spark_trees(frame):
    model = md.train_model(frame, feature_columns=FEATURES, kind="gbt", params={"maxIter": 3, "maxDepth": 3})
    want = [0] * len(FEATURES)
    for tree in model.pipeline.stages[-1].trees:
        open_ = [tree._call_java("rootNode")]
        while open_:
            node = open_.pop()
            if node.subtreeDepth():
                want[node.split().featureIndex()] += 1
                open_ += [node.leftChild(), node.rightChild()]
    assert {r.feature: r.splits for r in md.split_counts(model).collect()} == dict(zip(FEATURES, want))


def test_a_save_cut_off_leaves_the_last_version(frame, tmp_dir, monkeypatch):
    first = md.train_model(frame, feature_columns=FEATURES, horizon_hours=6)
    first.save(tmp_dir)
    second = md.train_model(frame, feature_columns=FEATURES[:2], horizon_hours=24)
    with monkeypatch.context() as patch:
        patch.setattr(md.json, "dumps", lambda *_: (_ for _ in ()).throw(RuntimeError("cut off")))
        with pytest.raises(RuntimeError):
            second.save(tmp_dir)  # the pipeline is written, the commit is not
    assert len([f for f in os.listdir(tmp_dir) if f.startswith("version-")]) == 2
    assert md.load_model_bundle(tmp_dir).feature_names == FEATURES
    second.save(tmp_dir)
    assert md.load_model_bundle(tmp_dir).feature_names == FEATURES[:2]
    assert md.load_model_bundle(tmp_dir, version=1).horizon_hours == 6
    with pytest.raises(FileNotFoundError):
        md.load_model_bundle(tmp_dir, version=9)
