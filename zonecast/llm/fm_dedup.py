"""Exact substring dedup with FM-indexes over content shards.

A window is ``window`` consecutive words of one document; it goes when the
same words start earlier (smaller id, or earlier in the same document).

Comparing every document with the index of every shard would take documents
times shards. Instead the shards are cut by content: a window's *anchor* is
the smallest of its ``ANCHOR``-word hashes (the first of equals), which equal
windows share. Consecutive windows with one anchor form a *segment*. Segments
are dealt by anchor, so equal windows meet in one shard:

1. equal segments settle themselves: all but the earliest lose their windows,
   and only the earliest goes on, if its anchor has other segments as well;
2. in each shard a compressed FM-index (a wavelet matrix over the Burrows-
   Wheeler transform of the shard's segments) is built, and the segments are
   streamed through it: backward search gives each window's occurrences, those
   with an earlier one are reported as intervals;
3. intervals are put together per document and the covered words dropped.

Hot content: copies of a segment are combined before each shuffle, in the
task that makes them. An anchor with more than ``HOT`` different segments (a
passage in a great many contexts) is cut finer: its windows are dealt one by
one by their own hash, equal ones combined first, so no shard grows with it.

Words, anchors and segments are told apart by 64-bit hashes in step 1; step 2
compares the words themselves.

Defined cases: a null or empty text has no words; texts below a window lose
nothing; of repeated rows of an id each keeps what the others keep (the same
start is not earlier); rows with one id and different texts are one document,
in the order of a hash of their texts; a null id sorts after all others; an
empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import NULL_ID, Words, byte_slices, documents_view, store, texts_of

WINDOW = 20
ANCHOR = 6
#: Different segments of one anchor from which on its windows are dealt singly.
HOT = 2000
#: Words a shard's index holds, about; whole anchors only.
SHARD_WORDS = 1 << 20
#: Order within which suffixes are sorted: at least a window, a power of two.
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Place of a text among those of its id, above the word position.
_PART = 40

_OTHERS = pa.list_(pa.struct([("doc", pa.int64()), ("start", pa.int64())]))
_OTHERS_SQL = "array<struct<doc:long,start:long>>"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def range_hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of codes[begin:end] for each pair, the same wherever it stands."""
    n = len(codes)
    inverse = pow(int(_BASE), -1, 2**64)
    up = _powers(n)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(codes * up, dtype=np.uint64)))
    down = np.full(n + 1, np.uint64(inverse), dtype=np.uint64)
    down[0] = 1
    down = np.multiply.accumulate(down)
    return _mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def window_anchors(codes: np.ndarray, starts: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(window starts, place of each one's anchor) for all windows that lie in
    one document."""
    n = len(codes)
    if n < window:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rolled = np.zeros(n - anchor + 1, dtype=np.uint64)
    for k in range(anchor):
        rolled = rolled * np.uint64(0x100000001B3) + codes[k:n - anchor + 1 + k]
    rolled = _mix(rolled)
    of_doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    at = np.flatnonzero(of_doc[:n - window + 1] == of_doc[window - 1:])
    width = window - anchor + 1
    first = np.lib.stride_tricks.sliding_window_view(rolled, width).argmin(axis=1)
    return at, at + first[at]


def segments(codes: np.ndarray, starts: np.ndarray, window: int, anchor: int):
    """Maximal runs of windows with one anchor: (start, windows, anchor hash,
    segment hash)."""
    at, place = window_anchors(codes, starts, window, anchor)
    if not len(at):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z.astype(np.uint64), z.astype(np.uint64)
    fresh = np.concatenate(([True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)))
    begin = np.flatnonzero(fresh)
    first = at[begin]
    count = np.diff(np.append(begin, len(at)))
    where = place[begin]
    return first, count, range_hashes(codes, where, where + anchor), range_hashes(codes, first, first + count + window - 1)


def _combined(key: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal keys of a batch the earliest (by doc, then start), and the
    others that are later."""
    order = np.lexsort((start, doc, key))
    k = key[order]
    fresh = np.concatenate(([True], k[1:] != k[:-1])) if len(k) else np.zeros(0, dtype=bool)
    lead = order[np.maximum.accumulate(np.where(fresh, np.arange(len(k)), 0))]
    later = ~fresh & ((doc[order] != doc[lead]) | (start[order] != start[lead]))
    return order[fresh], order[later]


def _view(docs: DataFrame) -> DataFrame:
    """``doc`` (id, null as the largest), ``base`` (place of the text among
    those of its id, shifted above word positions), ``doc_id``, ``text``."""
    view = documents_view(docs).withColumn("doc", F.coalesce("doc_id", F.lit(NULL_ID)))
    marks = view.select("doc", F.xxhash64("text").alias("h"))
    several = store(
        marks.groupBy("doc").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a != b").select("doc"), "ids-with-texts"
    )
    if several.isEmpty():
        return view.withColumn("base", F.lit(0).cast("long"))
    nth = (
        marks.join(several, "doc", "left_semi").distinct()
        .withColumn("base", F.shiftleft((F.row_number().over(Window.partitionBy("doc").orderBy("h")) - 1).cast("long"), _PART))
    )
    return (
        view.withColumn("h", F.xxhash64("text")).join(nth, ["doc", "h"], "left")
        .select("doc_id", "text", "doc", F.coalesce("base", F.lit(0).cast("long")).alias("base"))
    )


def _rows(batch: pa.RecordBatch, starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc, start within the document) of flat positions."""
    of = np.searchsorted(starts, at, side="right") - 1
    doc = batch.column("doc").to_numpy(zero_copy_only=False)[of]
    return doc, at - starts[of] + batch.column("base").to_numpy(zero_copy_only=False)[of]


def segment_rows(view: DataFrame, window: int, anchor: int) -> DataFrame:
    """``anchor``, ``seg``, ``doc``, ``start``, ``m`` (windows), ``copy``: of
    equal segments of a batch only the earliest stands under its anchor; the
    others are known to go (``copy``) and get an anchor of their own, so that
    they spread over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches):
            words = Words(batch.column("text"))
            starts = words.starts
            at, m, anchors, segs = segments(words.hashes, starts, window, anchor)
            if not len(at):
                continue
            doc, start = _rows(batch, starts, at)
            lead, copies = _combined(anchors * np.uint64(31) + segs, doc, start)
            every = np.concatenate((lead, copies))
            copy = np.arange(len(every)) >= len(lead)
            own = _mix(doc[every].astype(np.uint64) * _BASE + start[every].astype(np.uint64))
            yield pa.RecordBatch.from_pydict({
                "anchor": pa.array(np.where(copy, own, anchors[every]).view(np.int64)),
                "seg": pa.array(np.where(copy, np.uint64(0), segs[every]).view(np.int64)),
                "doc": pa.array(doc[every]), "start": pa.array(start[every]), "m": pa.array(m[every].astype(np.int32)), "copy": pa.array(copy),
            })

    return view.select("doc", "base", "text").mapInArrow(run, "anchor long, seg long, doc long, start long, m int, copy boolean")


def settled_segments(rows: DataFrame) -> DataFrame:
    """One shuffle by anchor. ``doc``, ``start``, ``m`` of segments whose
    windows all go (``gone``) or that go on to the index; ``hot`` marks those
    of an anchor with many segments."""
    by_anchor = Window.partitionBy("anchor")
    in_order = Window.partitionBy("anchor", "seg").orderBy("doc", "start")
    placed = (
        rows.repartition("anchor")
        .withColumn("lead", F.first(F.struct("doc", "start")).over(in_order))
        .withColumn("nth", F.row_number().over(in_order))
        .withColumn("segs", F.sum(F.when(F.col("nth") == 1, 1)).over(by_anchor))
    )
    later = (F.col("doc") != F.col("lead.doc")) | (F.col("start") != F.col("lead.start"))
    goes_on = (F.col("nth") == 1) & (F.col("segs") > 1)
    gone = F.col("copy") | later
    return placed.where(goes_on | gone).select("anchor", "doc", "start", "m", gone.alias("gone"), (F.col("segs") > HOT).alias("hot"))


# ---- FM-index ----------------------------------------------------------------
def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of ``text`` by the first ``depth`` symbols or more
    (doubling), ties in text order. That order answers backward searches for
    patterns of up to ``depth`` symbols."""
    rank = text.astype(np.int64)
    known = 1
    while True:
        following = np.zeros(len(rank), dtype=np.int64)
        if known < len(rank):
            following[:-known] = rank[known:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + following
        order = np.argsort(key, kind="stable")
        known *= 2
        if known >= depth:
            return order
        ordered = key[order]
        rank = np.empty(len(key), dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))


class WaveletMatrix:
    """Rank queries over a sequence of symbols: one packed bit vector a
    level, with counts per 64-bit word."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels = max(1, int(alphabet - 1).bit_length())
        self.words: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        self.zeros: list[int] = []
        now = symbols.astype(np.uint32)
        for level in range(self.levels - 1, -1, -1):
            bits = ((now >> np.uint32(level)) & np.uint32(1)).astype(bool)
            padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
            padded[:len(bits)] = bits
            words = np.packbits(padded, bitorder="little").view("<u8")
            counts = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.before.append(np.concatenate(([0], np.cumsum(counts)[:-1])))
            self.zeros.append(int(len(bits) - bits.sum()))
            now = np.concatenate((now[~bits], now[bits]))
        # where each symbol's run begins after the last level
        self.begin = np.searchsorted(self._order(now), self._order(np.arange(alphabet, dtype=np.uint32)))

    def _order(self, symbols: np.ndarray) -> np.ndarray:
        """Symbols with their bits reversed: the order after the last level."""
        out = np.zeros(len(symbols), dtype=np.uint32)
        for level in range(self.levels):
            out |= ((symbols >> np.uint32(level)) & np.uint32(1)) << np.uint32(self.levels - 1 - level)
        return out

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        at = at.copy()
        for k in range(self.levels):
            word = at >> 6
            ones = self.before[k][word] + np.bitwise_count(
                self.words[k][word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            )
            bit = (symbols >> (self.levels - 1 - k)) & 1
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return at - self.begin[symbols]


class FMIndex:
    """Backward search over a text of symbols 1.. with 0 between segments."""

    def __init__(self, text: np.ndarray, alphabet: int, depth: int):
        self.text = text
        self.suffixes = sorted_suffixes(text, depth)
        self.tree = WaveletMatrix(text[self.suffixes - 1], alphabet)
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=alphabet))))

    def window_intervals(self, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals [low, high) of the ``window`` symbols at each
        place. The search grows a match backward from the window's last
        symbol and stops where only one occurrence, the window itself, is
        left (low + 1 == high, the interval of the part matched so far)."""
        last = self.text[at + window - 1]
        low, high = self.smaller[last], self.smaller[last + 1]
        active = np.flatnonzero(high - low > 1)
        for k in range(window - 2, -1, -1):
            if not len(active):
                break
            symbol = self.text[at[active] + k]
            low[active] = self.smaller[symbol] + self.tree.rank(symbol, low[active])
            high[active] = self.smaller[symbol] + self.tree.rank(symbol, high[active])
            active = active[high[active] - low[active] > 1]
        return low, high


def repeated_windows(rows: list[tuple], window: int) -> tuple[list[int], list[int], list[int]]:
    """Windows of a shard that occur earlier in it, as (doc, start, windows)
    runs. ``rows``: (doc, start, m, words as bytes)."""
    split = [r[3].split() for r in rows]
    flat = [w for words in split for w in words]
    names = {w: i + 1 for i, w in enumerate(sorted(set(flat)))}
    lengths = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    text = np.zeros(len(flat) + len(rows), dtype=np.int64)
    begin = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    filled = np.ones(len(text), dtype=bool)
    filled[begin + lengths] = False
    text[filled] = np.fromiter(map(names.__getitem__, flat), dtype=np.int64, count=len(flat))
    index = FMIndex(text, len(names) + 1, window)
    count = np.fromiter((r[2] for r in rows), dtype=np.int64, count=len(rows))
    of = np.repeat(np.arange(len(rows)), count)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    at = begin[of] + nth
    low, high = index.window_intervals(at, window)
    doc = np.fromiter((r[0] for r in rows), dtype=np.int64, count=len(rows))[of]
    start = np.fromiter((r[1] for r in rows), dtype=np.int64, count=len(rows))[of] + nth
    # age of each window: its place by (doc, start), equal for equal places
    order = np.lexsort((start, doc))
    fresh = np.concatenate(([False], (doc[order][1:] != doc[order][:-1]) | (start[order][1:] != start[order][:-1])))
    age = np.empty(len(order), dtype=np.int64)
    age[order] = np.cumsum(fresh)
    by_place = np.full(len(text), np.iinfo(np.int64).max)
    by_place[at] = age
    several = np.flatnonzero(high - low > 1)
    found = np.zeros(len(at), dtype=bool)
    if len(several):
        ages = np.append(by_place[index.suffixes], np.iinfo(np.int64).max)
        interval, back = np.unique(np.stack((low[several], high[several])), axis=1, return_inverse=True)
        oldest = np.minimum.reduceat(ages, interval.T.ravel())[::2]
        found[several] = age[several] > oldest[back.ravel()]
    hits = np.flatnonzero(found)
    if not len(hits):
        return [], [], []
    run = np.concatenate(([True], (of[hits][1:] != of[hits][:-1]) | (nth[hits][1:] != nth[hits][:-1] + 1)))
    first = np.flatnonzero(run)
    return doc[hits[first]].tolist(), start[hits[first]].tolist(), np.diff(np.append(first, len(hits))).tolist()


_GONE = "doc long, start long, m int"


def shard_matches(view: DataFrame, going_on: DataFrame, window: int) -> DataFrame:
    """Windows that go, by the FM-index of their shard."""
    wanted = going_on.groupBy("doc").agg(F.collect_list(F.struct("start", "m", "anchor", "hot")).alias("parts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, limit=4 << 20):
            cols: dict[str, list] = {"route": [], "doc": [], "start": [], "m": [], "words": [], "others": []}
            single: dict[bytes, list] = {}
            for doc, base, text, parts in zip(*(batch.column(c).to_pylist() for c in ("doc", "base", "text", "parts"))):
                words = text.encode().split()
                for p in parts:
                    at = p["start"] - base
                    if not 0 <= at < 1 << _PART:  # of another text with this id
                        continue
                    if not p["hot"]:
                        for name, value in (("route", p["anchor"]), ("doc", doc), ("start", p["start"]), ("m", p["m"]),
                                            ("words", b" ".join(words[at:at + p["m"] + window - 1])), ("others", None)):
                            cols[name].append(value)
                    else:
                        for k in range(p["m"]):
                            single.setdefault(b" ".join(words[at + k:at + k + window]), []).append((doc, p["start"] + k))
            if single:
                from xxhash import xxh3_64_intdigest

                for words_, places in single.items():
                    places = sorted(set(places))
                    cols["route"].append(np.uint64(xxh3_64_intdigest(words_)).view(np.int64).item())
                    cols["doc"].append(places[0][0])
                    cols["start"].append(places[0][1])
                    cols["m"].append(1)
                    cols["words"].append(words_)
                    cols["others"].append([{"doc": d, "start": s} for d, s in places[1:]] or None)
            yield pa.RecordBatch.from_pydict({
                "route": pa.array(cols["route"], pa.int64()), "doc": pa.array(cols["doc"], pa.int64()), "start": pa.array(cols["start"], pa.int64()),
                "m": pa.array(cols["m"], pa.int32()), "words": pa.array(cols["words"], pa.binary()), "others": pa.array(cols["others"], _OTHERS),
            })

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, route = 0, None

        def report(rows, extra):
            doc, start, m = repeated_windows(rows, window) if rows else ([], [], [])
            return pa.RecordBatch.from_pydict({
                "doc": pa.array(doc + [o["doc"] for o in extra], pa.int64()), "start": pa.array(start + [o["start"] for o in extra], pa.int64()),
                "m": pa.array(m + [1] * len(extra), pa.int32()),
            })

        for batch in byte_slices(batches, "words", 4 << 20):
            extra: list = []
            for r, doc, start, m, words, others in zip(*(batch.column(c).to_pylist() for c in ("route", "doc", "start", "m", "words", "others"))):
                if others:
                    extra += others
                if r != route and size >= SHARD_WORDS:
                    yield report(held, [])
                    held, size = [], 0
                route = r
                held.append((doc, start, m, words))
                size += m + window
            if extra:
                yield report([], extra)
        if held:
            yield report(held, [])

    texts = view.join(wanted, "doc").select("doc", "base", "text", "parts")
    pieces = texts.mapInArrow(cut, f"route long, doc long, start long, m int, words binary, others {_OTHERS_SQL}")
    return pieces.repartition("route").sortWithinPartitions("route").mapInArrow(match, _GONE)


def repeated_intervals(docs_view: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc``, ``start``, ``m``: runs of windows that go (they may overlap)."""
    settled = store(settled_segments(segment_rows(docs_view, window, anchor)), "segments")
    copies = settled.where("gone").select("doc", "start", "m")
    matched = shard_matches(docs_view, settled.where("not gone").select("doc", "start", "m", "anchor", "hot"), window)
    return copies.unionByName(matched)


def dedup_substrings(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per row of ``docs`` ``doc_id``, ``n_words``, ``n_removed``, ``kept``
    (the words that stay, joined by a space) and ``kept_sha256``."""
    view = _view(docs)
    gone = repeated_intervals(view, window=window, anchor=anchor)
    spans = gone.groupBy("doc").agg(F.collect_list(F.struct("start", "m")).alias("spans"))
    joined = view.join(spans, "doc", "left").select("doc_id", "base", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches):
            n_words, n_removed, kept = [], [], []
            spans_of = batch.column("spans")
            for i, (base, text) in enumerate(zip(batch.column("base").to_pylist(), texts_of(batch))):
                words = text.split()
                n = len(words)
                if spans_of[i].is_valid and n:
                    flat = spans_of[i].values
                    at = flat.field("start").to_numpy() - base
                    m = flat.field("m").to_numpy()
                    own = (at >= 0) & (at < n)
                    cover = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(cover, at[own], 1)
                    np.add.at(cover, np.minimum(at[own] + m[own] + window - 1, n), -1)
                    stay = np.cumsum(cover[:-1]) == 0
                    words = [words[k] for k in np.flatnonzero(stay).tolist()]
                n_words.append(n)
                n_removed.append(n - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                "kept": pa.array([k.decode() for k in kept], pa.string()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            })

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
