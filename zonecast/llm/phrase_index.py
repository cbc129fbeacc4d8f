"""Benchmark decontamination on a distributed positional inverted index.

The index is partitioned by document: a segment holds the postings of some
whole documents, term by term, as positions in the segment (documents lie
``GAP`` apart, so no phrase crosses from one to the next). Segments are rows
of a written table; searching reads the table, and in each segment a phrase is
found by intersecting the offset-adjusted lists of its terms from the rarest
on. Nothing is shuffled, and each task holds one segment.

Defined cases: a null or empty document or item has no words; such an item has
no window; an item shorter than a window is one window of its length; repeated
windows and items count once, items with the same id are one item, a null item
id reads as an empty string; an item id with a comma is taken as it is; no
documents or no items give no matches; other columns are ignored; rows of
documents are judged one by one, also when they share an id or have none.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import Words, byte_slices, documents_view, hashes_of, store

#: Words of a decontamination window.
WINDOW = 10
#: Positions between two documents of a segment; proximity must stay below.
GAP = 64
#: A segment is closed when it has so many words (4 bytes each in postings).
SEGMENT_WORDS = 1 << 20
#: Text of the items that are searched together; more items take more passes
#: over the written index.
QUERY_BYTES = 16 << 20

#: Words of the contract: digits, lower-case letters and all beyond ASCII;
#: A-Z fold to lower case, the rest separates.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def index_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


SEGMENT_SCHEMA = "segment long, doc_ids array<long>, n_words array<long>, terms binary, list_ends binary, postings binary"


def build_index(docs: DataFrame, *, vocabulary: list[bytes] | None = None, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Write the positional index of all documents and return its table.

    Terms are named by 64-bit hashes (sorted in ``terms``); ``list_ends`` says
    where each term's positions end in ``postings``. ``vocabulary`` limits the
    stored terms to those that will be asked for; no other term can be part of
    a match.
    """
    asked = None if vocabulary is None else np.unique(hashes_of(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        made = held = 0
        ids: list[int | None] = []
        counts: list[np.ndarray] = []
        hashes: list[np.ndarray] = []

        def segment():
            lengths, flat = np.concatenate(counts), np.concatenate(hashes)
            at = np.arange(len(flat)) + GAP * np.repeat(np.arange(len(lengths)), lengths)
            if asked is not None and len(asked):
                place = np.minimum(np.searchsorted(asked, flat), len(asked) - 1)
                stored = asked[place] == flat
                flat, at = flat[stored], at[stored]
            elif asked is not None:
                flat, at = flat[:0], at[:0]
            order = np.argsort(flat, kind="stable")
            terms, first = np.unique(flat[order], return_index=True)
            return pa.RecordBatch.from_pydict({
                "segment": pa.array([(part << 32) | made], pa.int64()),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())), "n_words": pa.array([lengths.tolist()], pa.list_(pa.int64())),
                "terms": pa.array([terms.astype("<u8").tobytes()], pa.binary()),
                "list_ends": pa.array([np.append(first[1:], len(flat)).astype("<u4").tobytes() if len(terms) else b""], pa.binary()),
                "postings": pa.array([at[order].astype("<u4").tobytes()], pa.binary()),
            })

        for batch in byte_slices(batches, limit=2 << 20):
            words = Words(batch.column("text"), fold=_FOLD)
            ids += batch.column("doc_id").to_pylist()
            counts.append(np.diff(words.starts))
            hashes.append(words.hashes)
            held += len(words.hashes) + GAP * batch.num_rows
            if held >= segment_words:
                yield segment()
                ids, counts, hashes, held, made = [], [], [], 0, made + 1
        if ids:
            yield segment()

    return store(documents_view(docs).mapInArrow(run, SEGMENT_SCHEMA), "positional-index")


def item_windows(items: list[tuple[str, bytes]], window: int | None) -> tuple[list[bytes], list[tuple[str, np.ndarray]]]:
    """Distinct terms, and each item's distinct windows as places in them.
    ``window`` None: each item is one phrase."""
    code: dict[bytes, int] = {}
    out: list[tuple[str, np.ndarray]] = []
    seen: set[tuple] = set()
    for name, text in items:
        words = [code.setdefault(w, len(code)) for w in index_words(text)]
        if not words:
            continue
        size = len(words) if window is None else min(window, len(words))
        for i in range(len(words) - size + 1):
            key = (name, *words[i:i + size])
            if key not in seen:
                seen.add(key)
                out.append((name, np.array(words[i:i + size], dtype=np.int64)))
    return list(code), out


def find_phrase(lists: list[np.ndarray], slop: int = 0) -> np.ndarray:
    """Start positions of a phrase from its terms' sorted position lists:
    offset-adjusted lists, rarest first. ``slop`` lets every other term stand
    up to so many positions from its place (proximity match)."""
    by_size = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    starts = lists[by_size[0]] - by_size[0]
    for k in by_size[1:]:
        if not len(starts):
            break
        wanted = starts + k
        if slop:
            found = np.searchsorted(lists[k], wanted + slop, side="right") > np.searchsorted(lists[k], wanted - slop)
        else:
            place = np.searchsorted(lists[k], wanted)
            found = lists[k][np.minimum(place, len(lists[k]) - 1)] == wanted
        starts = starts[found]
    return starts


def search_index(index: DataFrame, items: list[tuple[str, bytes]], *, window: int | None = WINDOW, slop: int = 0) -> DataFrame:
    """All matches of the items' windows (or whole items) in every document.

    Per document of the index one row: ``segment``, ``nth`` (its place there),
    ``doc_id``, ``n_words``, ``item_ids`` with a match, and ``spans``: merged
    [start, end) word ranges covered by matches.
    """
    if not 0 <= slop < GAP:
        raise ValueError(f"slop must be from 0 to {GAP - 1}")
    named, windows = item_windows(items, window)
    terms = hashes_of(named)
    # places of each window's terms side by side; short ones are filled with a
    # place behind the last term, which counts as there in every segment
    longest = max((len(w) for _, w in windows), default=1)
    table = np.full((len(windows), longest), len(named), dtype=np.int32)
    for i, (_, places) in enumerate(windows):
        table[i, :len(places)] = places
    owners, sizes = [name for name, _ in windows], np.array([len(w) for _, w in windows], dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield _search_segment(batch.slice(row, 1).to_pylist()[0], terms, owners, table, sizes, slop)

    return index.mapInArrow(
        run, "segment long, nth int, doc_id long, n_words long, item_ids array<string>, spans array<struct<a:long,b:long>>"
    )


def _search_segment(seg: dict, terms: np.ndarray, owners: list[str], table: np.ndarray, sizes: np.ndarray, slop: int) -> pa.RecordBatch:
    postings = np.frombuffer(seg["postings"], "<u4").astype(np.int64)
    ends = np.frombuffer(seg["list_ends"], "<u4").astype(np.int64)
    begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    held = np.frombuffer(seg["terms"], "<u8")
    here = np.full(len(terms), -1, dtype=np.int64)
    if len(held):
        place = np.minimum(np.searchsorted(held, terms), len(held) - 1)
        here = np.where(held[place] == terms, place, -1)
    lengths = np.array(seg["n_words"], dtype=np.int64)
    firsts = np.concatenate(([0], np.cumsum(lengths + GAP)[:-1]))
    docs = len(lengths)
    hits: list[tuple[np.ndarray, int]] = []
    names: dict[int, set[str]] = {}
    cache: dict[int, np.ndarray] = {}
    # windows of which a term is not in the segment go all together
    there = np.append(here >= 0, True)
    possible = np.arange(len(table))
    for column in range(table.shape[1]):
        possible = possible[there[table[possible, column]]]
    for w in possible.tolist():
        name, size = owners[w], int(sizes[w])
        lists = []
        for c in here[table[w, :size]].tolist():
            if c not in cache:
                cache[c] = postings[begins[c]:ends[c]]
            lists.append(cache[c])
        starts = find_phrase(lists, slop)
        if len(starts):
            hits.append((starts, size))
            for d in np.unique(np.searchsorted(firsts, starts, side="right") - 1).tolist():
                names.setdefault(d, set()).add(name)
    spans: list[list[dict]] = [[] for _ in range(docs)]
    if hits:
        starts = np.concatenate([s for s, _ in hits])
        stops = np.concatenate([s + k for s, k in hits])
        order = np.argsort(starts, kind="stable")
        starts, stops = starts[order], np.maximum.accumulate(stops[order])
        fresh = np.concatenate(([True], starts[1:] > stops[:-1]))
        a = starts[fresh]
        b = stops[np.concatenate((np.flatnonzero(fresh)[1:] - 1, [len(starts) - 1]))]
        for x, y, d in zip(a.tolist(), b.tolist(), (np.searchsorted(firsts, a, side="right") - 1).tolist()):
            base = int(firsts[d])
            spans[d].append({"a": max(0, x - base), "b": min(int(lengths[d]), y - base)})
    return pa.RecordBatch.from_pydict({
        "segment": pa.array([seg["segment"]] * docs, pa.int64()), "nth": pa.array(range(docs), pa.int32()),
        "doc_id": pa.array(seg["doc_ids"], pa.int64()), "n_words": pa.array(seg["n_words"], pa.int64()),
        "item_ids": pa.array([sorted(names.get(d, ())) for d in range(docs)], pa.list_(pa.string())),
        "spans": pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
    })


def benchmark_slices(benchmark: DataFrame, limit: int = QUERY_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The items in slices of about ``limit`` bytes: the size is measured
    first, each slice is fetched by a hash of the item."""
    view = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = view.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = 1 + size // limit
    for i in range(slices):
        part = view if slices == 1 else view.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == i)
        yield [(r["item_id"], r["text"].encode()) for r in part.toLocalIterator()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Per document ``doc_id``, ``n_words``, ``n_hit`` (words inside any
    matched window), ``item_ids`` (sorted as strings) and ``spans``.

    With more items than one slice holds, the index of all terms is built
    once and searched slice by slice; spans are merged per document.
    """
    slices = benchmark_slices(benchmark, query_bytes)
    first = next(slices)
    more = next(slices, None)
    vocabulary = item_windows(first, window)[0] if more is None else None
    index = build_index(docs, vocabulary=vocabulary)
    found = search_index(index, first, window=window)
    if more is not None:
        found = store(found, "matches")
        while more is not None:
            found = found.unionByName(store(search_index(index, more, window=window), "matches"))
            more = next(slices, None)
        found = found.groupBy("segment", "nth").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        )
    # words covered: sorted spans, each counted from where the last one ended
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["b"] - F.greatest(s["a"], acc["end"]))).alias("n"),
            F.greatest(acc["end"], s["b"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    return found.select("doc_id", "n_words", covered.alias("n_hit"), "item_ids", "spans")


def keep_clean(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """The documents without any benchmark window, all columns. Documents
    that share an id go when one of them is contaminated; rows with a null id
    are judged each by its own text."""

    def clean(rows: DataFrame, key) -> DataFrame:
        view = rows.select(key.alias("doc_id"), "text")
        dirty = decontaminate(view, benchmark, window=window).where("n_hit > 0").select(F.col("doc_id").alias("_zc_id")).distinct()
        return rows.join(dirty, key == dirty["_zc_id"], "left_anti")

    named = clean(docs.where(F.col("doc_id").cast("long").isNotNull()), F.col("doc_id").cast("long"))
    nameless = docs.where(F.col("doc_id").cast("long").isNull())
    if nameless.isEmpty():
        return named
    return named.unionByName(clean(nameless, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))))


def items_digest(item_ids):
    """Column: SHA-256 of the comma-joined ids."""
    return F.sha2(F.array_join(item_ids, ","), 256)
