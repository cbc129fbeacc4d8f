"""Quality rules: hashed n-gram logistic regression beside fixed base rules.

``text_measures`` are the rule counts; ``train_quality`` fits a logistic
regression on hashed word and character n-grams of a bounded
sample of labelled rows and calibrates its probabilities on a part held out
of the fit (Platt's sigmoid); ``score_quality`` scores whole texts in Arrow
batches against a fixed threshold.

Defined cases: a null or empty text has no words, fails the base rules and is
not kept. Labels that are null, or that name no document, are not used;
repeated labels of a document count once, as the smallest. When the labels
hold fewer than ``MIN_CLASS`` rows of a class there is no verdict to learn:
the model passes everything and the base rules alone decide. An empty table
gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import Words, byte_slices, documents_view, store, texts_of

#: Fixed rule values.
MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
#: Probability of being good below which a document goes.
THRESHOLD = 0.5
#: Labelled rows used for a fit, at most; those with the smallest hash of
#: their id, classes drawn alike.
SAMPLE_PER_CLASS = 2000
MIN_CLASS = 5
#: Hashed feature space, and n-gram orders of words and of bytes.
DIMS = 1 << 16
WORD_ORDERS = (1, 2)
CHAR_ORDERS = (3, 4, 5)

_MIX = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def repeated_window_words(codes: np.ndarray, starts: np.ndarray, size: int = REPEAT_WINDOW) -> np.ndarray:
    """Words per text inside windows of ``size`` words whose sequence occurs
    twice or more in that text."""
    n, texts = len(codes), len(starts) - 1
    out = np.zeros(texts, dtype=np.int64)
    if n < size:
        return out
    of_text = np.repeat(np.arange(texts), np.diff(starts))
    rolled = np.zeros(n - size + 1, dtype=np.uint64)
    for k in range(size):
        rolled = rolled * np.uint64(0x100000001B3) + _mix(codes[k:n - size + 1 + k] + np.uint64(k))
    inside = of_text[:n - size + 1] == of_text[size - 1:]
    key = _mix(rolled + of_text[:n - size + 1].astype(np.uint64) * np.uint64(_MIX))
    at = np.flatnonzero(inside)
    order = np.argsort(key[at], kind="stable")
    ordered = key[at][order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    hits = at[order[twice]]
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, hits, 1)
    np.add.at(cover, hits + size, -1)
    covered = np.cumsum(cover[:-1]) > 0
    return np.add.reduceat(np.append(covered.astype(np.int64), 0), np.minimum(starts[:-1], n)) * (np.diff(starts) > 0)


def text_measures(texts: list[bytes], codes: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """Rule counts of each text."""
    n_words = np.diff(starts)
    word_chars, n_symbols, n_dup = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
    keep_symbols = bytes(c for c in range(256) if c not in b"#*$%&|<>")
    for i, text in enumerate(texts):
        bare = text.translate(None, b" \t\n\x0b\x0c\r")
        word_chars[i] = len(bare) if bare.isascii() else len(bare.decode("utf-8", "replace"))
        n_symbols[i] = len(bare.translate(None, keep_symbols))
        lines = [x for x in text.split(b"\n") if x.strip()]
        n_dup[i] = len(lines) - len(set(lines))
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup,
        "n_repeat_words": repeated_window_words(codes, starts),
    }


def ngram_slots(texts: list[bytes], codes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slot, text number) arrays of all hashed n-grams, one order at a time."""
    n = len(codes)
    of_word = np.repeat(np.arange(len(texts)), np.diff(starts))
    for size in WORD_ORDERS:
        if n >= size:
            h = np.full(n - size + 1, size, dtype=np.uint64)
            for k in range(size):
                h = _mix(h + codes[k:n - size + 1 + k] * np.uint64(_MIX))
            ok = of_word[:n - size + 1] == of_word[size - 1:]
            yield (h[ok] >> np.uint64(40)).astype(np.int64) % DIMS, of_word[:n - size + 1][ok]
    flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    of_char = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    m = len(flat)
    for size in CHAR_ORDERS:
        if m >= size:
            h = np.full(m - size + 1, size + 977, dtype=np.uint32)
            for k in range(size):
                h = h * np.uint32(0x01000193) + flat[k:m - size + 1 + k]
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            ok = of_char[:m - size + 1] == of_char[size - 1:]
            yield (h[ok] >> np.uint32(16)).astype(np.int64) % DIMS, of_char[:m - size + 1][ok]


@dataclass(frozen=True)
class QualityModel:
    """Weights in the hashed space, intercept, Platt's two parameters.
    ``weights`` None: nothing could be learnt, everything passes."""

    weights: np.ndarray | None
    intercept: float
    slope: float
    offset: float

    def probabilities(self, texts: list[bytes], codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(texts))
        total, norm = np.zeros(len(texts)), np.zeros(len(texts))
        for slots, of in ngram_slots(texts, codes, starts):
            total += np.bincount(of, weights=self.weights[slots], minlength=len(texts))
            norm += np.bincount(of, minlength=len(texts))
        margin = self.intercept + total / np.maximum(norm, 1)
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))


#: Shares of n-grams are scaled by this before the fit, so that the penalty
#: acts alike on every document length.
_SCALE = 1000.0


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches, limit=256 << 10):
        texts = texts_of(batch)
        words = Words(batch.column("text"))
        codes, starts = words.hashes, words.starts
        slots, of = (np.concatenate(x) for x in zip(*[*ngram_slots(texts, codes, starts), (np.zeros(0, np.int64), np.zeros(0, np.int64))]))
        key, count = np.unique(of.astype(np.int64) * DIMS + slots, return_counts=True)
        doc, slot = key // DIMS, key % DIMS
        total = np.bincount(doc, weights=count, minlength=len(texts))
        value = _SCALE * count / total[doc]
        edges = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
        yield pa.RecordBatch.from_pydict({
            "label": batch.column("label"), "held": batch.column("held"),
            "slots": pa.array([slot[a:b].astype("<i4").tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
            "shares": pa.array([value[a:b].astype("<f4").tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
        })


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """``doc_id``, ``text``, ``label``, ``held``: at most ``per_class``
    labelled documents of each class, those whose id hashes lowest; of each
    class every fifth, from the first on, is held out of the fit. An id with
    several texts counts with the one whose hash is smallest."""
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0.0, 1.0))
        .groupBy("doc_id").agg(F.min("label").alias("label"))
    )
    known = documents_view(docs).select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    order = F.xxhash64("doc_id", F.lit("quality sample"))
    marks = marks.join(known, "doc_id", "left_semi").withColumn("_zc_h", order)
    picked = None
    for label in (0.0, 1.0):
        # the classes' rows with the lowest hashes: a bounded top-k each
        few = marks.where(F.col("label") == label).orderBy("_zc_h", "doc_id").limit(per_class)
        picked = few if picked is None else picked.unionByName(few)
    # at most 2 * per_class rows of a few numbers: bounded by the parameter
    place = F.row_number().over(Window.partitionBy("label").orderBy("_zc_h", "doc_id"))
    picked = picked.select("doc_id", "label", (place % 5 == 1).alias("held"))
    texts = documents_view(docs).join(F.broadcast(picked), "doc_id")
    text = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    return texts.groupBy("doc_id", "label", "held").agg(text).select("doc_id", "text", "label", "held")


class SparseRows:
    """Rows of a sparse matrix, with the two products a fit needs; both run
    over pieces of whole rows with about a million entries."""

    def __init__(self, batches: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """``batches``: (slots, shares, entries of each row)."""
        self.slots = np.concatenate([np.zeros(0, np.int32), *(b[0] for b in batches)])
        self.shares = np.concatenate([np.zeros(0, np.float32), *(b[1] for b in batches)])
        self.lengths = np.concatenate([np.zeros(0, np.int64), *(b[2] for b in batches)])
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))

    def _pieces(self):
        part = self.starts[:-1] >> 20
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        return ((a, b, slice(self.starts[a], self.starts[b])) for a, b in zip(edges, edges[1:]) if b > a)

    def times(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.lengths))
        for a, b, s in self._pieces():
            some = a + np.flatnonzero(self.lengths[a:b])
            if len(some):
                out[some] = np.add.reduceat(weights[self.slots[s]] * self.shares[s], self.starts[some] - self.starts[a])
        return out

    def transposed_times(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(DIMS)
        for a, b, s in self._pieces():
            out += np.bincount(self.slots[s], weights=np.repeat(values[a:b], self.lengths[a:b]) * self.shares[s], minlength=DIMS)
        return out


def _flat_column(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """A binary column's values as one array, and how many each row has."""
    sizes = pc.binary_length(column).to_numpy().astype(np.int64) // 4
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(column[i].as_buffer(), kind) for i in range(len(column)))]), sizes


def fit_logistic(x: SparseRows, y: np.ndarray, used: np.ndarray, reg: float, steps: int, memory: int = 8) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the mean logistic loss of the rows
    ``used`` plus ``reg / 2`` times the squared weights: limited-memory BFGS with
    backtracking."""

    def loss(p):
        margin = x.times(p[:-1]) + p[-1]
        value = np.mean(np.logaddexp(0.0, np.where(y > 0, -margin, margin))[used]) + 0.5 * reg * np.dot(p[:-1], p[:-1])
        error = np.where(used, (1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500))) - y) / used.sum(), 0.0)
        return value, np.append(x.transposed_times(error) + reg * p[:-1], error.sum())

    p = np.zeros(DIMS + 1)
    value, gradient = loss(p)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        direction = -gradient
        factors = []
        for s, d, scale in reversed(moves):
            a = scale * np.dot(s, direction)
            direction = direction - a * d
            factors.append(a)
        if moves:
            s, d, scale = moves[-1]
            direction = direction / (scale * np.dot(d, d))
        else:
            direction = direction / max(1.0, np.linalg.norm(gradient))
        for (s, d, scale), a in zip(moves, reversed(factors)):
            direction = direction + (a - scale * np.dot(d, direction)) * s
        slope, step = np.dot(gradient, direction), 1.0
        while step > 1e-10:
            new_value, new_gradient = loss(p + step * direction)
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, d = step * direction, new_gradient - gradient
        if np.dot(s, d) > 1e-12:
            moves = [*moves, (s, d, 1.0 / np.dot(s, d))][-memory:]
        small = abs(value - new_value) <= 1e-7 * max(abs(value), 1e-12)
        p, value, gradient = p + s, new_value, new_gradient
        if small:
            break
    return p[:-1], float(p[-1])


def train_quality(docs: DataFrame, labels: DataFrame, *, per_class: int = SAMPLE_PER_CLASS, reg: float = 1e-4, max_iter: int = 60) -> QualityModel:
    """Fit and calibrate. The sample (see ``labelled_sample``) is bounded by
    ``2 * per_class`` rows whatever the size of the tables; its n-grams are
    counted by many tasks, one task fits their sparse rows."""
    sample = labelled_sample(docs, labels, per_class).repartition(12, "doc_id")
    rows = store(sample.select("label", "held", "text").mapInArrow(_feature_rows, "label double, held boolean, slots binary, shares binary"), "quality-features")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, held, parts = [], [], []
        for batch in batches:
            label += batch.column("label").to_pylist()
            held += batch.column("held").to_pylist()
            slots, lengths = _flat_column(batch.column("slots"), "<i4")
            parts.append((slots, _flat_column(batch.column("shares"), "<f4")[0], lengths))
        y, out = np.array(label), np.array(held, dtype=bool)
        if min(sum(y == 0), sum(y == 1)) < MIN_CLASS:
            return  # with so many of each class, both parts have both
        x = SparseRows(parts)
        parts.clear()
        weights, intercept = fit_logistic(x, y, ~out, reg, max_iter)
        margins, kept = (x.times(weights) + intercept)[out], out
        slope, offset = platt(margins, y[kept])
        yield pa.RecordBatch.from_pydict({
            "weights": pa.array([(weights * _SCALE).astype("<f8").tobytes()], pa.binary()), "intercept": pa.array([intercept], pa.float64()),
            "slope": pa.array([slope], pa.float64()), "offset": pa.array([offset], pa.float64()),
        })

    found = rows.coalesce(1).mapInArrow(fit, "weights binary, intercept double, slope double, offset double").collect()
    if not found:
        return QualityModel(None, 0.0, 1.0, 0.0)
    one = found[0]
    return QualityModel(np.frombuffer(one["weights"], "<f8"), one["intercept"], one["slope"], one["offset"])


def platt(margins: np.ndarray, labels: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Newton fit of ``sigmoid(slope * margin + offset)`` to smoothed
    targets; a slope that would turn the order round is not accepted."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        g = np.array([np.dot(p - target, margins), np.sum(p - target)])
        w = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[np.dot(w, margins * margins), np.dot(w, margins)], [np.dot(w, margins), w.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def score_quality(docs: DataFrame, model: QualityModel, *, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the measures, ``probability``,
    ``base_failed`` and ``kept``. One pass, no shuffle; the model (``DIMS``
    weights) travels with the task."""
    view = documents_view(docs)
    return view.mapInArrow(_scorer(model, threshold, ()), _SCORED)


_SCORED = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES) + ", probability double, base_failed boolean, kept boolean"


def keep_good(docs: DataFrame, model: QualityModel, *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, all their columns unchanged."""
    run = _scorer(model, threshold, None)
    return docs.mapInArrow(run, docs.schema)


def _scorer(model: QualityModel, threshold: float, passing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, limit=1 << 20):
            texts = texts_of(batch)
            words = Words(batch.column("text"))
            codes, starts = words.hashes, words.starts
            m = text_measures(texts, codes, starts)
            p = model.probabilities(texts, codes, starts)
            failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])
            kept = ~failed & (p >= threshold)
            if passing is None:
                yield batch.filter(pa.array(kept))
                continue
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), **{k: pa.array(m[k], pa.int64()) for k in MEASURES},
                "probability": pa.array(p, pa.float64()), "base_failed": pa.array(failed), "kept": pa.array(kept),
            })

    return run
