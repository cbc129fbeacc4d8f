"""Runs of periodically repeated words, found with an enhanced suffix array.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are equal) that no neighbouring word extends. Branching tandem repeats
(Stoye and Gusfield, "Simple and flexible detection of contiguous repeats")
are read off the suffix array: a square ``ww`` that the next word breaks has
its two halves' suffixes in different children of the LCP interval of depth
``|w|``. For every interval the suffixes of all children but the largest ask
the inverse suffix array whether the suffix ``depth`` words further, or before,
lies in another child of the same interval. Each square found so is the last
of its run; rotating it to the left as long as words agree gives the run's
start. Intervals and children are index ranges: no tree is built.

A run of at least ``min_length`` words and ``min_exponent`` periods repeats a
stretch of ``seed_words`` words at a distance of one period, so its words all
lie in sequences of that many words that occur twice in the text. Everything
outside of those is left out before suffixes are sorted; this drops no run.

Documents are independent: one pass without a shuffle, all texts of an Arrow
slice together in NumPy. Words are told apart by 64-bit hashes.

Defined results: null or empty text: no words, no runs, collapsed text empty.
Ids play no part: null and repeated ids are rows of their own. Of an empty
table comes an empty one. Very long texts are worked on whole. Other columns
of the input are left out.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from zonecast.llm.common import Words, byte_slices, documents_view, texts_of

MIN_LENGTH = 6
MIN_EXPONENT = 4

#: Suffixes asked in one step, which bounds the memory of the test.
ASKED = 1 << 20

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def collapse_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per document ``doc_id``, ``n_words``, its ``runs`` (start as word number
    from 0, length, period; by start, then period) and the ``collapsed`` text:
    the words, joined by one space, without those that a run holds after its
    first period."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two words and two periods at least")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches):
            words = Words(batch.column("text"))
            start, length, period = find_runs(words.hashes, words.starts, min_length, min_exponent)
            gone = np.zeros(len(words.hashes) + 1, dtype=np.int64)
            np.add.at(gone, start + period, 1)
            np.add.at(gone, start + length, -1)
            gone = np.cumsum(gone) > 0
            texts = []
            for a, b, text in zip(words.starts[:-1].tolist(), words.starts[1:].tolist(), texts_of(batch)):
                held = text.split()
                if gone[a:b].any():
                    held = [held[i] for i in np.flatnonzero(~gone[a:b]).tolist()]
                texts.append(b" ".join(held))
            edges = np.searchsorted(start, words.starts)
            first = words.starts[:-1][np.searchsorted(words.starts, start, "right") - 1]
            found = pa.StructArray.from_arrays([pa.array(x) for x in (start - first, length, period)], fields=list(RUNS.value_type))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(words.starts)),
                    pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), found, type=RUNS),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return documents_view(docs).mapInArrow(work, SCHEMA)


def seed_words(min_length: int, min_exponent: int) -> int:
    """How many words every run shares with itself one period further on: a
    run of ``n`` words shares ``n - q``, and ``n`` is at least ``min_length``
    and ``min_exponent * q``."""
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1))


def find_runs(symbols: np.ndarray, starts: np.ndarray, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (in ``symbols``), length and period of the runs of all texts;
    text ``t`` is ``symbols[starts[t]:starts[t + 1]]``. Ordered by start, then
    period."""
    rounds = seed_words(min_length, min_exponent).bit_length() - 1
    twice = rank_prefixes(symbols, starts, rounds)[1]
    held = np.zeros(len(symbols) + 1, dtype=np.int64)
    held[twice] += 1
    np.subtract.at(held, np.minimum(twice + (1 << rounds), len(symbols)), 1)
    kept = np.flatnonzero(np.cumsum(held[:-1]) > 0)
    text = np.searchsorted(starts, kept, "right")
    cuts = np.flatnonzero((np.diff(kept) > 1) | (np.diff(text) > 0)) + 1
    edges = np.concatenate(([0], cuts, [len(kept)])) if len(kept) else np.zeros(1, np.int64)
    start, length, period = runs_of(symbols[kept], edges)
    long = (length >= min_length) & (length >= min_exponent * period)
    start, length, period = kept[start[long]] if len(kept) else start, length[long], period[long]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def rank_prefixes(symbols: np.ndarray, edges: np.ndarray, rounds: int = 64) -> tuple[list[np.ndarray], np.ndarray]:
    """Prefix doubling over strings side by side (string ``s`` is
    ``symbols[edges[s]:edges[s + 1]]``).

    Level ``t`` ranks all suffixes by string, then their first ``2^t`` symbols:
    a rank is the place of the first suffix that is equal so far, so suffixes
    that stand alone keep theirs and only the others are sorted again. Ends when
    all stand alone, or after ``rounds``; returns the levels and the positions
    that do not stand alone."""
    n = len(symbols)
    text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    stop = edges[1:][text] if n else edges[:0]
    distinct, symbol = np.unique(symbols, return_inverse=True)
    rank, reach = np.zeros(n, dtype=np.int32), 1
    open_, key = np.arange(n), text * (len(distinct) + 1) + symbol
    place = np.zeros(n, dtype=np.int64)  # where the group of each open suffix begins
    levels: list[np.ndarray] = []
    while True:
        by = np.argsort(key, kind="stable")
        open_, key, place = open_[by], key[by], place[by]
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        heads = np.flatnonzero(new)
        group = np.ones(len(key), dtype=bool)
        group[1:] = place[1:] != place[:-1]
        within = np.arange(len(key)) - np.maximum.accumulate(np.where(group, np.arange(len(key)), 0)) if len(key) else key
        size = np.diff(np.append(heads, len(key)))
        place = np.repeat((place + within)[heads], size)
        rank = rank.copy()
        rank[open_] = place
        levels.append(rank)
        more = np.repeat(size > 1, size)
        open_, place = open_[more], place[more]
        if not len(open_) or len(levels) > rounds:
            return levels, open_
        ahead = open_ + reach
        key = place * (n + 1) + np.where(ahead < stop[open_], rank[np.minimum(ahead, n - 1)].astype(np.int64) + 1, 0)
        reach *= 2


def runs_of(symbols: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all runs (two periods at least)
    of strings side by side."""
    none = np.zeros(0, dtype=np.int64)
    if not len(symbols):
        return none, none, none
    levels, _ = rank_prefixes(symbols, edges)
    isa = levels.pop().astype(np.int64)
    at, depth = branching_squares(levels, isa)
    # rotate to the left, in steps of powers of two, as long as the words agree
    low = edges[np.searchsorted(edges, at, "right") - 1]
    x = at.copy()
    for t in reversed(range(len(levels))):
        to = x - (1 << t)
        x = np.where((to >= low) & (levels[t][np.maximum(to, 0)] == levels[t][np.maximum(to, 0) + depth]), to, x)
    end = at + 2 * depth
    by = np.lexsort((depth, end, x))
    x, end, depth = x[by], end[by], depth[by]
    # a run is found once for each multiple of its period that fits twice
    least = np.ones(len(x), dtype=bool)
    least[1:] = (x[1:] != x[:-1]) | (end[1:] != end[:-1])
    return x[least], (end - x)[least], depth[least]


def branching_squares(levels: list[np.ndarray], isa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and half length of the squares that the next symbol breaks."""
    n = len(isa)
    sa = np.empty(n, dtype=np.int64)
    sa[isa] = np.arange(n)
    lcp = common_prefixes(levels, sa)
    split = np.flatnonzero(lcp > 0)
    depth = lcp[split]
    lows = range_minima(lcp)
    left, right = walk_left(lows, split, depth), walk_right(lows, split, depth)
    # children: from each split to the next one, and what lies before the first
    first = walk_left(lows, split, depth + 1) == left
    a = np.concatenate((split, left[first]))
    b = np.concatenate((walk_right(lows, split, depth + 1), split[first]))
    owner = np.concatenate((np.arange(len(split)), np.flatnonzero(first)))
    begin, end, depth = left[owner], right[owner], depth[owner]
    by = np.lexsort((b - a, end, begin))
    last = np.ones(len(by), dtype=bool)  # the largest child of each interval
    last[:-1] = (begin[by][1:] != begin[by][:-1]) | (end[by][1:] != end[by][:-1])
    asked = by[~last]
    parts = np.cumsum((b - a)[asked]) // ASKED
    found = []
    for part in np.split(asked, np.flatnonzero(np.diff(parts)) + 1):
        size = (b - a)[part]
        child = np.repeat(part, size)
        i = sa[a[child] + np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size)]
        for step in (depth[child], -depth[child]):
            j = i + step
            r = isa[np.clip(j, 0, n - 1)]
            square = (j >= 0) & (j < n) & (r >= begin[child]) & (r < end[child]) & ((r < a[child]) | (r >= b[child]))
            found.append(np.minimum(i, j)[square] * (n + 1) + depth[child][square])
    squares = np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)
    return squares // (n + 1), squares % (n + 1)


def common_prefixes(levels: list[np.ndarray], sa: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix in order and the one before
    it (none for the first), by halving steps over the levels."""
    x, y = sa[:-1].copy(), sa[1:].copy()
    for t in reversed(range(len(levels))):
        level = np.append(levels[t], -1)
        same = level[x] == level[y]
        x += same.astype(np.int64) << t
        y += same.astype(np.int64) << t
    return np.concatenate(([0], y - sa[1:]))


def range_minima(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all ranges whose length is a power of two."""
    rows, size = [values.astype(np.int32)], 1
    while 2 * size <= len(values):
        rows.append(np.minimum(rows[-1][:-size], rows[-1][size:]))
        size *= 2
    return rows


def walk_left(lows: list[np.ndarray], at: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """The last place before ``at`` whose value is below ``bound`` (there is one)."""
    to = at.copy()
    for t in reversed(range(len(lows))):
        back = to - (1 << t)
        to = np.where((back >= 0) & (lows[t][np.maximum(back, 0)] >= bound), back, to)
    return to - 1


def walk_right(lows: list[np.ndarray], at: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """The first place after ``at`` whose value is below ``bound``, or the end."""
    to = at + 1
    for t in reversed(range(len(lows))):
        fits = to + (1 << t) <= len(lows[0])
        to = np.where(fits & (lows[t][np.where(fits, to, 0)] >= bound), to + (1 << t), to)
    return to
