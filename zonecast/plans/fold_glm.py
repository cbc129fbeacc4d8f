"""Poisson regressions of all folds and all penalties in shared passes.

An expanding-window backtest fits the same design on growing prefixes of the
data. Instead of one fit after another, every model (a fold with a penalty) is
carried through the same iterations: one pass over the design computes the
weighted normal equations of all models that have not converged, sums are
added up by Spark, and the driver solves one small system per model. The
number of jobs is the number of iterations of the slowest model, whatever the
number of folds and penalties.

The design is written once as blocks of rows (a NumPy matrix, the target and
the first fold whose training set holds the row; later folds hold it too). A
pass sends (features + 1)^2 numbers per model and task to one grouped sum;
neither depends on the number of rows.

The estimate is the penalised maximum likelihood of a Poisson model with log
link, found by iteratively reweighted least squares: ridge penalty
``regParam / 2`` times the squared coefficients (not the intercept) beside the
mean weighted squared error, as Spark ML's ``GeneralizedLinearRegression`` has
it. Columns are centred and scaled inside, which changes nothing but the
rounding. Columns without variance in a fold have coefficient 0 there.
"""
from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.session import materialize

# executors need no installed copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 16_384
#: Linear predictors are kept within these bounds while iterating.
ETA_LIMIT = 30.0


@dataclass(frozen=True)
class FoldModel:
    """One fitted model: ``eta = intercept + sum(coefficients * design)``."""

    fold: int
    penalty: float
    intercept: float
    coefficients: tuple[float, ...]
    iterations: int
    converged: bool


def design_blocks(frame: DataFrame, columns: Sequence[str | Column], target: str | Column, first_fold: str | Column) -> DataFrame:
    """The design as a written table of blocks: ``x`` (rows x columns), ``y``
    and ``first`` as little-endian arrays, ``rows``."""
    width = len(columns)
    named = [(F.col(c) if isinstance(c, str) else c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    y = (F.col(target) if isinstance(target, str) else target).cast("double").alias("y")
    first = (F.col(first_fold) if isinstance(first_fold, str) else first_fold).cast("int").alias("first")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = np.stack([part.column(i).to_numpy(zero_copy_only=False) for i in range(width)], axis=1)
                y = part.column(width).to_numpy(zero_copy_only=False)
                first = part.column(width + 1).to_numpy(zero_copy_only=False).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows]), *[pa.array([a.tobytes()], pa.binary()) for a in (x, y, first)]], ["rows", "x", "y", "first"]
                )

    packed = frame.select(*named, y, first).mapInArrow(pack, "rows long, x binary, y binary, first binary")
    return materialize(packed, name="design")


def read_blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        x, y, first = (batch.column(c).to_pylist() for c in ("x", "y", "first"))
        for i in range(batch.num_rows):
            yield np.frombuffer(x[i]).reshape(-1, width), np.frombuffer(y[i]), np.frombuffer(first[i], np.int32)


def summed(blocks: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], dict[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """``work`` maps the blocks of a task to ``{key: array}``; arrays of equal
    keys are added up, element by element, in one grouped aggregation."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, values in work(batches).items():
            flat = values.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), key, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["key", "place", "value"])

    rows = blocks.mapInArrow(emit, "key int, place int, value double").groupBy("key", "place").agg(F.sum("value").alias("value")).toArrow()
    key, place, value = (rows.column(c).to_numpy() for c in ("key", "place", "value"))
    out = {}
    for k in np.unique(key).tolist():
        mine = key == k
        array = np.zeros(place[mine].max() + 1)
        array[place[mine]] = value[mine]
        out[k] = array
    return out


def fold_moments(blocks: DataFrame, width: int, folds: Sequence[int]) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Rows, means and variances of the design in each fold's training rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        out: dict[int, np.ndarray] = {}
        for x, _, first in read_blocks(batches, width):
            for fold in folds:
                held = x[first <= fold]
                if len(held):
                    mean = held.mean(axis=0)
                    # sums around the block's mean lose no digits to large values
                    part = np.concatenate(([len(held)], held.sum(axis=0), ((held - mean) ** 2).sum(axis=0), len(held) * mean**2))
                    out[fold] = out.get(fold, 0) + part
        return out

    moments = {}
    for fold, s in summed(blocks, work).items():
        n, total, inner, outer = s[0], s[1:width + 1], s[width + 1:2 * width + 1], s[2 * width + 1:]
        mean = total / n
        between = np.maximum(outer / n - mean**2, 0.0)
        between[between < 1e-12 * mean**2] = 0.0  # what is left of equal means
        spread = inner / n + between
        moments[fold] = (n, mean, np.where(spread > 1e-24 * mean**2, spread, 0.0))
    return moments


def fit_folds(
    blocks: DataFrame,
    width: int,
    folds: Sequence[int],
    penalties: Sequence[float],
    *,
    max_iter: int | Sequence[int] = 50,
    tol: float = 1e-7,
) -> dict[tuple[int, int], FoldModel]:
    """``{(fold, number of the penalty): model}`` of every fold that has
    training rows. ``max_iter`` may differ from penalty to penalty."""
    limits = [max_iter] * len(penalties) if isinstance(max_iter, int) else list(max_iter)
    moments = fold_moments(blocks, width, folds)
    # one centre and scale for all models, so that a pass standardises once
    _, centre, spread = moments[max(moments)] if moments else (0.0, np.zeros(width), np.zeros(width))
    scale = np.where(spread > 0, np.sqrt(spread), 1.0)
    open_: dict[int, tuple[int, int]] = {}
    beta: dict[tuple[int, int], np.ndarray] = {}
    for fold in moments:
        for p in range(len(penalties)):
            open_[len(open_)] = (fold, p)
    done: dict[tuple[int, int], FoldModel] = {}
    step = 0
    while open_:
        step += 1
        start = {k: beta.get(m) for k, m in open_.items()}
        sums = _normal_equations(blocks, width, centre, scale, {k: (open_[k][0], b) for k, b in start.items()})
        still = {}
        for k, (fold, p) in open_.items():
            active = np.append(True, moments[fold][2] > 0)
            new = _solve(sums[k], width, penalties[p] / scale**2, active)
            old = beta.get((fold, p))
            beta[fold, p] = new
            raw_new = new[1:] / scale
            change = np.inf
            if old is not None:
                raw_old = old[1:] / scale
                both = np.append(raw_new, new[0] - raw_new @ centre) - np.append(raw_old, old[0] - raw_old @ centre)
                size = np.maximum(1.0, np.abs(np.append(raw_new, new[0] - raw_new @ centre)))
                change = float(np.max(np.abs(both) / size))
            if change < tol or step > limits[p]:
                done[fold, p] = FoldModel(fold, penalties[p], float(new[0] - raw_new @ centre), tuple(raw_new.tolist()), step, change < tol)
            else:
                still[len(still)] = (fold, p)
        open_ = still
    return done


def _normal_equations(blocks: DataFrame, width: int, centre: np.ndarray, scale: np.ndarray, models: dict[int, tuple[int, np.ndarray | None]]) -> dict[int, np.ndarray]:
    """For each model the weighted sums of the outer products of (1, x, z)."""

    def work(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        out: dict[int, np.ndarray] = {}
        for x, y, first in read_blocks(batches, width):
            whole = np.empty((len(y), width + 2))
            whole[:, 0] = 1.0
            np.subtract(x, centre, out=whole[:, 1:-1])
            whole[:, 1:-1] /= scale
            for k, (fold, b) in models.items():
                # a first guess of the mean needs no coefficients
                eta = np.log(np.maximum(y, 0.1)) if b is None else np.clip(whole[:, :-1] @ b, -ETA_LIMIT, ETA_LIMIT)
                mu = np.exp(eta)
                whole[:, -1] = eta + (y - mu) / mu
                weighted = whole * np.where(first <= fold, mu, 0.0)[:, None]
                out[k] = out.get(k, 0) + weighted.T @ whole
        return out

    return summed(blocks, work)


def _solve(sums: np.ndarray, width: int, ridge: np.ndarray, active: np.ndarray) -> np.ndarray:
    """Penalised least squares from the sums; inactive columns stay at 0."""
    s = sums.reshape(width + 2, width + 2) / sums[0]
    left = s[:-1, :-1] + np.diag(np.append(0.0, ridge))
    at = np.flatnonzero(active)
    out = np.zeros(width + 1)
    out[at] = np.linalg.lstsq(left[np.ix_(at, at)], s[at, -1], rcond=None)[0]
    return out


def score_column(models: Mapping[int, FoldModel], columns: Sequence[str | Column], key: str | Column) -> Column:
    """The prediction of the model that each row's ``key`` names: its numbers
    are looked up once per row, the rest is plain arithmetic."""
    number = (F.col(key) if isinstance(key, str) else key).cast("int")
    table = F.create_map(*[x for k, m in models.items() for x in (F.lit(k), F.array(*[F.lit(float(v)) for v in (m.intercept, *m.coefficients)]))])
    mine = F.element_at(table, number)
    eta = F.get(mine, F.lit(0))
    for i, c in enumerate(columns):
        eta = eta + F.get(mine, F.lit(i + 1)) * (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.exp(eta)
