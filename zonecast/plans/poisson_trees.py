"""Boosted Poisson trees, fitted by Newton steps over distributed histograms.

The model is ``rate = exp(base + sum of trees)``. Every round fits one tree to
the gradient ``y - rate`` and the curvature ``rate`` of the Poisson likelihood:
a node's value is the Newton step ``sum(y - rate) / (sum(rate) + l2)`` times the
learning rate (the sum above moved towards 0 by ``l1``), a split's gain the drop
of the quadratic loss it brings. Of a level's splits those of the largest gain
are made, as long as the tree has fewer than ``max_leaves``.

Features are cut into at most ``bins`` bins at their exact quantiles, found for
all features together (``functions/selection.py``). Rows are written once as
blocks of bin numbers with their target. A level of a tree is one Spark job:

* every task adds up gradient, curvature and rows per node, feature and bin;
* the sums of a feature meet in one group, whatever the number of rows, and
  that group finds its best split of each node;
* the driver picks the best feature of each node: nodes x features rows.

Rows carry no state between jobs: a task applies the trees that the last
written table of raw scores does not hold yet. That table is written anew every
``WRITE_EVERY`` trees, so neither the work of a pass nor the lineage grows with
the number of trees.

Explanations are exact path-dependent Shapley values: of a leaf's path only the
conditions a row meets matter, so a leaf has one table with a row for each
pattern of met conditions, and a row of the data looks up its pattern.
"""
from __future__ import annotations

import itertools
import json
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.selection import quantile_table
from zonecast.session import materialize

# executors need no installed copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULTS = {"rounds": 60, "learning_rate": 0.1, "max_depth": 5, "max_leaves": 31, "min_rows": 20, "l1": 0.0, "l2": 1.0, "bins": 64, "feature_share": 1.0, "row_share": 1.0, "seed": 42}
BLOCK_ROWS = 16_384
WRITE_EVERY = 10

NODE_SCHEMA = "tree int, node int, feature string, threshold double, left int, right int, value double, rows long, cover double, gain double"


@dataclass
class Tree:
    """Arrays over the nodes, the root first. ``feature`` is -1 at a leaf; a
    row goes left where its value is at most ``threshold``. ``bin`` is the
    threshold as a number of its feature's cuts."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])
    cover: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def add(self) -> int:
        for values, empty in ((self.feature, -1), (self.bin, 0), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0), (self.rows, 0), (self.cover, 0.0), (self.gain, 0.0)):
            values.append(empty)
        return len(self.feature) - 1

    def nodes_of(self, x: np.ndarray, cuts: Sequence) -> np.ndarray:
        """The node each row of ``x`` ends in; ``cuts`` are the bins or the
        thresholds, as ``x`` holds the one or the other."""
        feature, cut = np.array(self.feature), np.array(cuts)
        left, right = np.array(self.left), np.array(self.right)
        at = np.zeros(len(x), dtype=np.int64)
        going = np.flatnonzero(feature[at] >= 0)
        while len(going):
            here = at[going]
            low = x[going, feature[here]] <= cut[here]
            at[going] = np.where(low, left[here], right[here])
            going = going[feature[at[going]] >= 0]
        return at

    def leaves(self) -> Iterator[tuple[int, list[tuple[int, bool]]]]:
        """Every leaf with its path: (node, goes left)."""
        open_: list[tuple[int, list[tuple[int, bool]]]] = [(0, [])]
        while open_:
            node, path = open_.pop()
            if self.feature[node] < 0:
                yield node, path
            else:
                open_ += [(self.left[node], [*path, (node, True)]), (self.right[node], [*path, (node, False)])]


@dataclass
class Forest:
    """The trees of a fitted model and the features they name."""

    features: tuple[str, ...]
    base: float
    trees: list[Tree]
    losses: list[float] = field(default_factory=list)  # mean Poisson deviance before each round, and after the last

    def raw(self, x: np.ndarray, trees: Sequence[Tree] | None = None, binned: bool = False) -> np.ndarray:
        """Sum of the trees for rows of values (or of bin numbers)."""
        out = np.zeros(len(x))
        for tree in self.trees if trees is None else trees:
            out += np.array(tree.value)[tree.nodes_of(x, tree.bin if binned else tree.threshold)]
        return out

    def score(self, frame: DataFrame, column: str) -> DataFrame:
        """Adds the rate; rows with a null input are an error."""
        forest, names = self, list(self.features)
        schema = T.StructType([*frame.schema.fields, T.StructField(column, T.DoubleType())])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rate = np.exp(forest.base + forest.raw(values_of(batch, names)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], [*batch.schema.names, column])

        return frame.mapInArrow(work, schema)

    def bare(self) -> Forest:
        """Without trees: what a task needs beside those it is given."""
        return Forest(self.features, self.base, [])

    # -- tables ------------------------------------------------------------------
    def node_table(self, spark: SparkSession) -> DataFrame:
        """One row per node of every tree."""
        rows = [
            (t, i, self.features[tree.feature[i]] if tree.feature[i] >= 0 else None, tree.threshold[i] if tree.feature[i] >= 0 else None,
             tree.left[i], tree.right[i], tree.value[i], tree.rows[i], tree.cover[i], tree.gain[i])
            for t, tree in enumerate(self.trees) for i in range(len(tree.feature))
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def split_counts(self) -> list[tuple[str, float]]:
        used = [f for tree in self.trees for f in tree.feature]
        return [(name, float(used.count(i))) for i, name in enumerate(self.features)]

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "base": self.base, "losses": self.losses, "trees": [tree.__dict__ for tree in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> Forest:
        held = json.loads(text)
        return cls(tuple(held["features"]), held["base"], [Tree(**t) for t in held["trees"]], held["losses"])

    # -- explanations ---------------------------------------------------------------
    def explanation(self) -> Explanation:
        return Explanation(self)


def values_of(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    columns = [batch.column(c) for c in names]
    if empty := [c for c, held in zip(names, columns) if held.null_count]:
        raise ValueError(f"model input {empty[0]} is null")
    return np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns], axis=1) if columns else np.zeros((batch.num_rows, 0))


# ---- fitting ---------------------------------------------------------------------
def feature_cuts(frame: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """For each feature its inner cuts: distinct quantiles, ascending. A value
    lies in the bin of the number of cuts below it."""
    typed = frame.select(*[F.col(f).cast("double").alias(f) for f in features])
    long = typed.unpivot([], list(features), "feature", "value")
    counted = materialize(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c")), name="values")
    found = quantile_table(counted, "value", [i / bins for i in range(1, bins)], by=["feature"], weight="c")
    return [np.unique(found[(f,)]) if (f,) in found else np.zeros(0) for f in features]


def binned_blocks(frame: DataFrame, features: Sequence[str], target: str, cuts: Sequence[np.ndarray]) -> DataFrame:
    """Blocks of rows: bin numbers (rows x features, one byte each), targets
    and raw scores (all 0)."""
    names = list(features)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = values_of(part, names)
                bins = np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8)
                y = part.column("y").to_numpy(zero_copy_only=False)
                blobs = [pa.array([a.tobytes()], pa.binary()) for a in (bins, y, np.zeros(len(y)))]
                yield pa.RecordBatch.from_arrays([pa.array([part.num_rows]), *blobs], ["rows", "bins", "y", "raw"])

    packed = frame.select(*names, F.col(target).cast("double").alias("y")).mapInArrow(pack, BLOCK_SCHEMA)
    return materialize(packed, name="binned")


BLOCK_SCHEMA = "rows long, bins binary, y binary, raw binary"


def open_blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        bins, y, raw = (batch.column(c).to_pylist() for c in ("bins", "y", "raw"))
        for i in range(batch.num_rows):
            yield np.frombuffer(bins[i], np.uint8).reshape(-1, width), np.frombuffer(y[i]), np.frombuffer(raw[i])


def chosen_rows(bins: np.ndarray, y: np.ndarray, share: float, seed: int) -> np.ndarray:
    """Which rows a round learns from: told by a hash of what the row holds,
    so that a task that runs again chooses the same."""
    if share >= 1:
        return np.ones(len(y), dtype=bool)
    odd = np.random.default_rng(seed).integers(1, 2**62, bins.shape[1] + 2, dtype=np.uint64) | np.uint64(1)
    h = bins.astype(np.uint64) @ odd[:-2] + y.view(np.uint64) * odd[-2] + np.arange(len(y), dtype=np.uint64) * odd[-1]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(11)).astype(np.float64) / 2**53 < share


def train_forest(frame: DataFrame, features: Sequence[str], target: str, params: dict | None = None) -> Forest:
    """Fit on complete rows with a target of zero or more."""
    unknown = sorted(set(params or {}) - set(DEFAULTS))
    if unknown:
        raise ValueError(f"parameters without a meaning here: {', '.join(unknown)}")
    p = {**DEFAULTS, **(params or {})}
    if not 2 <= p["bins"] <= 256 or min(p["max_depth"], p["rounds"], p["min_rows"]) < 1 or p["max_leaves"] < 2:
        raise ValueError("bins lie from 2 to 256, leaves from 2; rounds, depth and rows of a leaf from 1")
    cuts = feature_cuts(frame, features, p["bins"])
    blocks = binned_blocks(frame, features, target, cuts)
    forest = Forest(tuple(features), 0.0, [])
    width = len(features)
    n, mean = _target_mean(blocks, width)
    forest.base = math.log(max(mean, 1e-12))
    pending: list[Tree] = []
    rng = np.random.default_rng(p["seed"])
    for turn in range(p["rounds"]):
        if len(pending) == WRITE_EVERY:
            blocks, pending = _with_scores(blocks, forest.bare(), width, pending), []
        asked = sorted(rng.choice(width, max(1, round(p["feature_share"] * width)), replace=False).tolist()) if width else []
        tree, loss = _grow(blocks, forest.bare(), width, cuts, pending, asked, p, p["seed"] * 1_000_003 + turn)
        forest.losses.append(loss / n)
        if tree is None:
            return forest
        forest.trees.append(tree)
        pending.append(tree)
    forest.losses.append(_deviance(blocks, forest.bare(), width, pending) / n)
    return forest


def _target_mean(blocks: DataFrame, width: int) -> tuple[int, float]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0.0
        for _, y, _ in open_blocks(batches, width):
            n, total = n + len(y), total + y.sum()
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([float(total)])], ["n", "total"])

    n, total = blocks.mapInArrow(work, "n long, total double").agg(F.sum("n"), F.sum("total")).first()
    if not n:
        raise ValueError("every row lacks an input or the target")
    return n, total / n


def _with_scores(blocks: DataFrame, forest: Forest, width: int, pending: list[Tree]) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, y, raw in open_blocks(batches, width):
            now = raw + forest.raw(bins, pending, binned=True)
            yield pa.RecordBatch.from_arrays([pa.array([len(y)]), *[pa.array([a.tobytes()], pa.binary()) for a in (bins, y, now)]], ["rows", "bins", "y", "raw"])

    return materialize(blocks.mapInArrow(work, BLOCK_SCHEMA), name="scores")


def deviance(y: np.ndarray, rate: np.ndarray) -> float:
    return float(2 * np.sum(np.where(y > 0, y * np.log(np.maximum(y, 1e-300) / rate), 0.0) - (y - rate)))


def _deviance(blocks: DataFrame, forest: Forest, width: int, pending: list[Tree]) -> float:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss = sum(deviance(y, np.exp(forest.base + raw + forest.raw(bins, pending, binned=True))) for bins, y, raw in open_blocks(batches, width))
        yield pa.RecordBatch.from_arrays([pa.array([float(loss)])], ["loss"])

    return blocks.mapInArrow(work, "loss double").agg(F.sum("loss")).first()[0]


def newton_step(slope, curve, p: dict):
    """The minimum of the penalised quadratic loss, before the learning rate."""
    return np.sign(slope) * np.maximum(np.abs(slope) - p["l1"], 0.0) / (curve + p["l2"])


def _grow(blocks: DataFrame, forest: Forest, width: int, cuts, pending: list[Tree], asked: list[int], p: dict, seed: int) -> tuple[Tree | None, float]:
    """One tree, level by level, and the deviance before it. None: no split
    brings anything."""
    tree, loss = Tree(), 0.0
    level = [0]
    for depth in range(p["max_depth"]):
        rows = _level_splits(blocks, forest, width, cuts, pending, tree, level, asked, p, seed).collect()
        if depth == 0:
            loss = max((r["loss"] for r in rows), default=0.0)
        best: dict[int, object] = {}
        for r in sorted(rows, key=lambda r: (-r["gain"], r["feature"], r["bin"])):
            node = level[r["place"]]
            tree.rows[node], tree.cover[node] = int(r["rows"]), r["curve"]
            if depth == 0:
                tree.value[node] = p["learning_rate"] * float(newton_step(r["slope"], r["curve"], p))
            if r["gain"] > 1e-12:
                best.setdefault(node, r)
        room = p["max_leaves"] - tree.feature.count(-1)
        level = []
        for node, r in sorted(list(best.items())[:max(room, 0)]):
            feature = int(r["feature"])
            tree.feature[node], tree.bin[node], tree.gain[node] = feature, int(r["bin"]), r["gain"]
            tree.threshold[node] = float(cuts[feature][int(r["bin"])])
            tree.left[node], tree.right[node] = tree.add(), tree.add()
            for child, slope, curve, n in (
                (tree.left[node], r["left_slope"], r["left_curve"], r["left_rows"]),
                (tree.right[node], r["slope"] - r["left_slope"], r["curve"] - r["left_curve"], r["rows"] - r["left_rows"]),
            ):
                tree.value[child] = p["learning_rate"] * float(newton_step(slope, curve, p))
                tree.rows[child], tree.cover[child] = int(n), curve
                level.append(child)
        if not level:
            break
    return (tree, loss) if tree.feature[0] >= 0 else (None, loss)


SPLIT_SCHEMA = "place int, feature int, bin int, gain double, slope double, curve double, rows double, left_slope double, left_curve double, left_rows double, loss double"


def _level_splits(blocks: DataFrame, forest: Forest, width: int, cuts, pending: list[Tree], tree: Tree, level: list[int], asked: list[int], p: dict, seed: int) -> DataFrame:
    """The best split of every node of the level for each feature, with the
    node's sums (gain 0 where a feature cannot split it)."""
    bins = p["bins"]
    place_of = np.full(len(tree.feature), -1)
    place_of[level] = np.arange(len(level))

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, loss = np.zeros((len(asked), 3, len(level) * bins)), 0.0
        for x, y, raw in open_blocks(batches, width):
            rate = np.exp(forest.base + raw + forest.raw(x, pending, binned=True))
            loss += deviance(y, rate) if level == [0] else 0.0
            place = place_of[tree.nodes_of(x, tree.bin)]
            held = np.flatnonzero((place >= 0) & chosen_rows(x, y, p["row_share"], seed))
            slope, curve, at = (y - rate)[held], rate[held], place[held] * bins
            for i, f in enumerate(asked):
                cell = at + x[held, f]
                for j, weights in enumerate((slope, curve, None)):
                    sums[i, j] += np.bincount(cell, weights, sums.shape[2])
        blobs = [sums[i].tobytes() for i in range(len(asked))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(asked, pa.int32()), pa.array(blobs, pa.binary()), pa.array([loss] * len(asked))], ["feature", "sums", "loss"]
        )

    def best_splits(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b) for b in table.column("sums").to_pylist()).reshape(3, len(level), bins)
        left = np.cumsum(total, axis=2)[:, :, :-1]
        whole = total.sum(axis=2)[:, :, None]
        right = whole - left
        score = lambda s: newton_step(s[0], s[1], p) ** 2 * (s[1] + p["l2"])
        gain = score(left) + score(right) - score(whole)
        gain[(left[2] < p["min_rows"]) | (right[2] < p["min_rows"])] = 0.0
        gain = np.maximum(gain, 0.0)
        at = gain.argmax(axis=1)
        pick = lambda a: a[np.arange(len(level)), at]
        feature = table.column("feature")[0].as_py()
        return pa.table({
            "place": pa.array(np.arange(len(level), dtype=np.int32)), "feature": pa.array([feature] * len(level), pa.int32()), "bin": pa.array(at.astype(np.int32)),
            "gain": pick(gain), "slope": whole[0, :, 0], "curve": whole[1, :, 0], "rows": whole[2, :, 0],
            "left_slope": pick(left[0]), "left_curve": pick(left[1]), "left_rows": pick(left[2]),
            "loss": np.full(len(level), float(sum(table.column("loss").to_pylist()))),
        })

    return blocks.mapInArrow(histograms, "feature int, sums binary, loss double").groupBy("feature").applyInArrow(best_splits, SPLIT_SCHEMA)


# ---- Shapley values -----------------------------------------------------------------
class Explanation:
    """Path-dependent Shapley values of a forest, leaf by leaf.

    A leaf's path names some features; a row meets all conditions on such a
    feature or not. Where a feature is left open, the row goes on with the
    share of the training rows' cover that meets its conditions. The Shapley
    values of that game depend only on which features are met: one table with
    2^features rows per leaf, computed once."""

    def __init__(self, forest: Forest):
        self.forest, self.leaves, self.expected = forest, [], forest.base
        for tree in forest.trees:
            for leaf, path in tree.leaves():
                if not path:
                    self.expected += tree.value[leaf]
                    continue
                names = list(dict.fromkeys(tree.feature[node] for node, _ in path))
                shares = dict.fromkeys(names, 1.0)
                for node, goes_left in path:
                    child = tree.left[node] if goes_left else tree.right[node]
                    whole = tree.cover[tree.left[node]] + tree.cover[tree.right[node]]
                    shares[tree.feature[node]] *= tree.cover[child] / whole if whole > 0 else 0.5
                share = np.array([shares[f] for f in names])
                bounds = [(names.index(tree.feature[node]), tree.feature[node], tree.threshold[node], goes_left) for node, goes_left in path]
                self.leaves.append((names, bounds, pattern_table(share, tree.value[leaf])))
                self.expected += tree.value[leaf] * float(share.prod())

    def values(self, x: np.ndarray) -> np.ndarray:
        """Rows x features; with ``expected`` they add up to the raw score."""
        out = np.zeros((len(x), len(self.forest.features)))
        for names, bounds, table in self.leaves:
            met = np.ones((len(names), len(x)), dtype=bool)
            for i, feature, threshold, goes_left in bounds:
                low = x[:, feature] <= threshold
                met[i] &= low if goes_left else ~low
            pattern = (1 << np.arange(len(names))) @ met
            out[:, names] += table[pattern]
        return out

    def explain(self, frame: DataFrame, keys: Sequence[str]) -> DataFrame:
        """``keys`` and one column ``phi`` with the row's values in order of
        the features."""
        here, names = self, list(self.forest.features)
        inputs = [f"__x{i}" for i in range(len(names))]
        schema = T.StructType([*frame.select(*keys).schema.fields, T.StructField("phi", T.ArrayType(T.DoubleType()))])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                phi = here.values(values_of(batch, inputs))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(phi) + 1, dtype=np.int32) * len(names)), pa.array(phi.ravel()))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keys], lists], [*keys, "phi"])

        return frame.select(*keys, *[F.col(f).cast("double").alias(i) for f, i in zip(names, inputs)]).mapInArrow(work, schema)


def pattern_table(share: np.ndarray, value: float) -> np.ndarray:
    """Shapley values of the game that pays ``value`` times the product over
    its players of 1 (in and met), 0 (in and not met) or their ``share``
    (out): one row for each pattern of met players (player i is bit i)."""
    m = len(share)
    out = np.zeros((1 << m, m))
    weight = [math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)]
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for size in range(m):
            for inside in itertools.combinations(others, size):
                outside = math.prod(share[j] for j in others if j not in inside)
                needed = sum(1 << j for j in inside)
                met = (np.arange(1 << m) & needed) == needed
                out[met, i] += weight[size] * outside
        own = (np.arange(1 << m) >> i) & 1
        out[:, i] *= (own - share[i]) * value
    return out
