"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

State is three tables. *Postings* say which document holds which line key how
often; inserting documents appends their rows with sign +1, deleting documents
appends the same rows with sign -1. *Counts* are the postings summed per key
held by two documents or more: lines, smallest and largest document. *Filters*
hold, shard by shard, a fingerprint for each of these keys in a cuckoo filter.

A batch changes only the shards that its keys fall into: their counts are
taken anew for the batch's keys from the postings of those shards (postings
are written in key order, so a shard is a range of each file), and where a key
crosses two documents its fingerprint is inserted into, or deleted from, the
shard's filter, which is read, changed and written back by one task. A filter
that overflows is built anew from its shard's counts. So a deletion undoes an
insertion exactly.

Finding what to drop: postings are dealt to the shards and probe their filter;
what the filter does not know is unshared for certain and ends there, the rest
(shared keys and rare false positives) is settled by the exact counts.

A line's key is the line stripped of ASCII white space at both ends with A-Z
lower-cased, as a 128-bit hash; keys below ``MIN_CHARS`` code points are never
shared.

Defined cases: a null or empty text is one empty line; rows with the same id
are one document (each row loses its own lines); null ids are one document
after all others, whose rows are told apart by a hash of their text, so they
never meet in one group; an empty table gives no rows; other columns are
ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import ASCII_SPACE, NULL_ID, byte_slices, documents_view, store, texts_of

MIN_CHARS = 10
#: Keys a shard's filter is sized for (2 bytes each at most half full), the
#: least number of tasks that share the rows of one shard, and the rows of
#: shared keys for which a shard gets one more of them.
SHARD_KEYS = 200_000
SALTS = 8
TASK_ROWS = 500_000
#: Ranges of keys that a read names; more are read as one.
MAX_RANGES = 200


def line_key(line: bytes) -> bytes:
    return line.strip(ASCII_SPACE).lower()


def keyed_lines(text: bytes) -> list[bytes | None]:
    """Per line the 16-byte key hash, None where the key is too short."""
    from xxhash import xxh3_128_digest

    out: list[bytes | None] = []
    for line in text.split(b"\n"):
        key = line_key(line)
        size = len(key)
        if size < MIN_CHARS or size < 4 * MIN_CHARS and not key.isascii() and len(key.decode("utf-8", "replace")) < MIN_CHARS:
            out.append(None)
        else:
            out.append(xxh3_128_digest(key))
    return out


def row_hash(text: bytes) -> int:
    """What tells rows of one id apart: 31 bits of a hash of the text. Texts
    of one id that share it are treated as one row, with the same result."""
    from xxhash import xxh32_intdigest

    return xxh32_intdigest(text) >> 1


def line_postings(docs: DataFrame) -> DataFrame:
    """``hi``, ``lo`` (the key hash), ``doc`` (id, null as the largest),
    ``row`` (hash of the text), ``lines``: one row per document row and key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches):
            keys: list[bytes] = []
            doc: list[int] = []
            row: list[int] = []
            lines: list[int] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                counts: dict[bytes, int] = {}
                for k in keyed_lines(text):
                    if k is not None:
                        counts[k] = counts.get(k, 0) + 1
                keys += counts
                lines += counts.values()
                doc += [NULL_ID if doc_id is None else doc_id] * len(counts)
                row += [row_hash(text)] * len(counts)
            halves = np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_pydict({
                "hi": pa.array(halves[:, 0]), "lo": pa.array(halves[:, 1]), "doc": pa.array(doc, pa.int64()), "row": pa.array(row, pa.int32()), "lines": pa.array(lines, pa.int32()),
            })

    return documents_view(docs).mapInArrow(run, "hi long, lo long, doc long, row int, lines int")


# ---- cuckoo filter -----------------------------------------------------------
class CuckooFilter:
    """Buckets of four 16-bit fingerprints (Fan et al., 2014). Batches of
    inserts, deletes and lookups run as NumPy operations; 0 marks a free slot.
    Keys must be distinct within the set, as reference counts make them."""

    SLOTS = 4

    def __init__(self, capacity: int):
        need = max(1, -(-2 * capacity // self.SLOTS))
        self.table = np.zeros((1 << (need - 1).bit_length(), self.SLOTS), dtype=np.uint16)

    @staticmethod
    def _print(keys: np.ndarray) -> np.ndarray:
        return ((keys >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        spread = (prints.astype(np.uint64) * np.uint64(0x5BD1E995)) ^ (prints.astype(np.uint64) >> np.uint64(7))
        return (bucket ^ (spread & np.uint64(len(self.table) - 1)).astype(np.int64))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, a = self._print(keys), self._first(keys)
        b = self._other(a, prints)
        return (self.table[a] == prints[:, None]).any(axis=1) | (self.table[b] == prints[:, None]).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """Add the keys; False (table full) leaves the filter unusable."""
        prints = self._print(keys)
        bucket = self._first(keys)
        rng = np.random.default_rng(len(keys))
        for turn in range(500):
            if not len(prints):
                return True
            prints, bucket = self._settle(prints, bucket)
            if not len(prints):
                return True
            bucket = self._other(bucket, prints)
            prints, bucket = self._settle(prints, bucket)
            if not len(prints):
                return True
            # both buckets full: one key per bucket takes a random slot, its holder moves on
            first = np.unique(bucket, return_index=True)[1]
            slot = rng.integers(0, self.SLOTS, size=len(first))
            out = self.table[bucket[first], slot].copy()
            self.table[bucket[first], slot] = prints[first]
            prints[first] = out
            bucket[first] = self._other(bucket[first], out)
        return False

    def _settle(self, prints: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put prints into free slots of their buckets; those without one."""
        order = np.argsort(bucket, kind="stable")
        prints, bucket = prints[order], bucket[order]
        fresh = np.concatenate(([True], bucket[1:] != bucket[:-1]))
        begin = np.flatnonzero(fresh)
        rank = np.arange(len(bucket)) - np.repeat(begin, np.diff(np.append(begin, len(bucket))))
        free = self.table[bucket] == 0
        fits = rank < free.sum(axis=1)
        nth = np.cumsum(free, axis=1)
        slot = ((nth == (rank + 1)[:, None]) & free).argmax(axis=1)
        self.table[bucket[fits], slot[fits]] = prints[fits]
        return prints[~fits], bucket[~fits]

    def delete(self, keys: np.ndarray) -> None:
        """Remove keys that were inserted before."""
        for p, a in zip(self._print(keys), self._first(keys).tolist()):
            for bucket in (a, int(self._other(np.array([a]), np.array([p]))[0])):
                at = np.flatnonzero(self.table[bucket] == p)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> "CuckooFilter":
        out = cls(0)
        out.table = np.frombuffer(blob, "<u2").reshape(-1, cls.SLOTS).copy()
        return out

    @classmethod
    def of(cls, keys: np.ndarray) -> "CuckooFilter":
        capacity = max(len(keys), 1)
        while True:
            out = cls(capacity)
            if out.insert(keys):
                return out
            capacity *= 2


def shard_of(bits: int):
    """Shard of a key: the top ``bits`` of ``lo``, a range of keys."""
    return F.shiftrightunsigned("lo", 64 - bits).cast("int")


def in_shards(shards: list[int], bits: int):
    """Whether a row's key is in one of the shards, as ranges of ``lo`` that
    reach the scan; many shards are read as the ranges' hull and checked."""
    width = 1 << (64 - bits)
    lows = sorted((s << (64 - bits)) - (1 << 64 if s >> (bits - 1) else 0) for s in shards)
    merged: list[list[int]] = []
    for low in lows:
        if merged and merged[-1][1] == low:
            merged[-1][1] = low + width
        else:
            merged.append([low, low + width])
    lo = F.col("lo")
    if len(merged) > MAX_RANGES:
        return lo.between(merged[0][0], merged[-1][1] - 1) & shard_of(bits).isin(shards)
    out = F.lit(False)
    for low, high in merged:
        out = out | lo.between(low, high - 1)
    return out


def _as_keys(column: pa.Array) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def build_filters(shared: DataFrame, bits: int) -> DataFrame:
    """``shard``, ``blob``: a filter for each shard of the shared keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        current = None

        def done():
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([current], pa.int32()), "blob": pa.array([CuckooFilter.of(np.concatenate(held)).to_bytes()], pa.binary()),
            })

        for batch in batches:
            shard, keys = batch.column("shard").to_numpy(), _as_keys(batch.column("hi"))
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]))
            for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                if a == b:
                    continue
                if current is not None and shard[a] != current:
                    yield done()
                    held = []
                current = int(shard[a])
                held.append(keys[a:b])
        if held:
            yield done()

    rows = shared.select(shard_of(bits).alias("shard"), "hi").repartition("shard").sortWithinPartitions("shard")
    return rows.mapInArrow(run, "shard int, blob binary")


def update_filters(filters: DataFrame, changes: DataFrame) -> DataFrame:
    """``shard``, ``blob`` of the shards in ``changes`` (``shard``, ``hi``,
    ``add``): fingerprints are deleted and inserted, a blob is null where
    they no longer fit. One task at a time holds one shard's filter."""
    none = F.lit(None)
    blobs = filters.join(changes.select("shard").distinct(), "shard", "left_semi")
    rows = blobs.select("shard", "blob", none.cast("long").alias("hi"), none.cast("boolean").alias("add")).unionByName(
        changes.select("shard", none.cast("binary").alias("blob"), "hi", "add"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known, added, gone = None, None, [], []

        def done():
            new = np.concatenate([np.zeros(0, np.uint64), *added])
            if known is None:
                blob = CuckooFilter.of(new).to_bytes()
            else:
                known.delete(np.concatenate([np.zeros(0, np.uint64), *gone]))
                blob = known.to_bytes() if known.insert(new) else None
            return pa.RecordBatch.from_pydict({"shard": pa.array([current], pa.int32()), "blob": pa.array([blob], pa.binary())})

        for batch in batches:
            shard = batch.column("shard").to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]))
            for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                if a == b:
                    continue
                if shard[a] != current:
                    if current is not None:
                        yield done()
                    current, known, added, gone = int(shard[a]), None, [], []
                piece = batch.slice(a, b - a)
                if piece.column("blob")[0].is_valid:
                    known = CuckooFilter.from_bytes(piece.column("blob")[0].as_py())
                    piece = piece.slice(1)
                if piece.num_rows:
                    keys, add = _as_keys(piece.column("hi")), piece.column("add").to_numpy(zero_copy_only=False).astype(bool)
                    added.append(keys[add])
                    gone.append(keys[~add])
        if current is not None:
            yield done()

    return rows.repartition("shard").sortWithinPartitions("shard", F.col("blob").isNull()).mapInArrow(run, "shard int, blob binary")


def probe_filters(postings: DataFrame, filters: DataFrame, shared: DataFrame, bits: int) -> DataFrame:
    """Postings whose key may be shared, by their shard's filter. A shard's
    rows go to ``SALTS`` tasks, to more if its shared keys have many rows;
    each task gets the filter as its first row and streams the rest."""
    rows_of = shared.groupBy(shard_of(bits).alias("shard")).agg(F.sum("refs").alias("refs"))
    salts = rows_of.select("shard", F.greatest(F.lit(SALTS), F.ceil(F.col("refs") / TASK_ROWS)).cast("int").alias("salts"))
    salts = store(salts, "line-salts")  # a row per shard
    salted = F.pmod(F.xxhash64("doc", "row"), F.col("salts")).cast("int")
    none = F.lit(None)
    blobs = filters.join(salts, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "blob",
        none.cast("long").alias("hi"), none.cast("long").alias("lo"), none.cast("long").alias("doc"), none.cast("int").alias("row"))
    rows = postings.withColumn("shard", shard_of(bits)).join(salts, "shard").select(
        "shard", salted.alias("salt"), none.cast("binary").alias("blob"), "hi", "lo", "doc", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known = None, None
        for batch in batches:
            shard, salt = batch.column("shard").to_numpy(), batch.column("salt").to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero((np.diff(shard) != 0) | (np.diff(salt) != 0)) + 1, [len(shard)]))
            for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                if a == b:
                    continue
                if (int(shard[a]), int(salt[a])) != current:
                    current, known = (int(shard[a]), int(salt[a])), None
                piece = batch.slice(a, b - a)
                if piece.column("blob")[0].is_valid:
                    known = CuckooFilter.from_bytes(piece.column("blob")[0].as_py())
                    piece = piece.slice(1)
                if known is not None and piece.num_rows:
                    hit = known.contains(_as_keys(piece.column("hi")))
                    yield piece.select(["hi", "lo", "doc", "row"]).filter(pa.array(hit))

    dealt = rows.unionByName(blobs).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("blob").isNull())
    return dealt.mapInArrow(run, "hi long, lo long, doc long, row int")


# ---- index -------------------------------------------------------------------
class LineIndex:
    """Line keys of a changing set of documents.

    ``insert`` and ``delete`` return the index after the batch; the one before
    stays usable, as tables are never changed in place. The first batch builds
    everything; later ones read and write the shards of their keys only.
    """

    def __init__(self, postings: DataFrame | None = None, counts: DataFrame | None = None, filters: DataFrame | None = None, bits: int = 1,
                 signed: bool = False, layers: int = 0):
        self.postings, self.counts, self.filters, self.bits, self.signed, self.layers = postings, counts, filters, bits, signed, layers

    @staticmethod
    def _write(rows: DataFrame, sign: int) -> DataFrame:
        """A batch of postings, each file in key order."""
        return store(rows.withColumn("sign", F.lit(sign).cast("byte")).sortWithinPartitions("lo"), "line-postings")

    def insert(self, docs: DataFrame) -> "LineIndex":
        return self._after(self._write(line_postings(docs), 1), self.signed)

    def delete(self, doc_ids: DataFrame) -> "LineIndex":
        """Take back all rows of the documents in ``doc_ids`` (``doc_id``).
        Their rows are looked up by id in one pass over the postings."""
        if self.postings is None:
            return self
        gone = doc_ids.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc")).distinct()
        return self._after(self._write(self._net(self.postings.join(gone, "doc", "left_semi")), -1), True)

    def _after(self, batch: DataFrame, signed: bool) -> "LineIndex":
        if self.postings is None:
            return LineIndex(batch, signed=signed).rebuilt()
        out = LineIndex(self.postings.unionByName(batch), self.counts, self.filters, self.bits, signed, self.layers + 1)
        keys = store(batch.select("hi", "lo").distinct(), "line-batch")
        touched = sorted(r[0] for r in keys.select(shard_of(self.bits).alias("s")).distinct().collect())  # numbers of shards
        if not touched:
            return out
        mine, held = in_shards(touched, self.bits), ["hi", "lo"]
        live = out.live(out.postings.where(mine).join(keys, held, "left_semi"))
        after = store(self.reference_counts(live).where("first_doc < last_doc"), "line-counts-of-batch")
        before = self.counts.where(mine).join(keys, held, "left_semi").select(*held)
        changes = (
            after.select(*held).join(before, held, "left_anti").select(shard_of(self.bits).alias("shard"), "hi", F.lit(True).alias("add"))
            .unionByName(before.join(after, held, "left_anti").select(shard_of(self.bits).alias("shard"), "hi", F.lit(False).alias("add")))
        )
        changes = store(changes, "line-crossings")
        rest = self.counts.where(mine).join(keys, held, "left_anti")
        out.counts = self.counts.where(~mine).unionByName(store(rest.unionByName(after), "line-counts"))
        changed = store(update_filters(self.filters, changes), "line-filters")
        full = [r[0] for r in changed.where("blob is null").select("shard").collect()]  # numbers of shards
        if full:
            again = build_filters(out.counts.where(in_shards(full, self.bits)), self.bits)
            changed = store(changed.where("blob is not null").unionByName(again), "line-filters")
        kept = self.filters.join(changed.select("shard"), "shard", "left_anti")
        out.filters = kept.unionByName(changed)
        if out.layers >= 16:  # short plans again, every shard one table
            out.counts, out.filters, out.layers = store(out.counts, "line-counts"), store(out.filters, "line-filters"), 0
            if out.counts.count() > 4 * SHARD_KEYS << self.bits:
                return out.rebuilt()
        return out

    def rebuilt(self) -> "LineIndex":
        """Counts, number of shards and filters from all postings."""
        counts = store(self.reference_counts(self.live()).where("first_doc < last_doc"), "line-counts")
        bits = max(1, (-(-counts.count() // SHARD_KEYS) - 1).bit_length())  # two shards at least, so that joins have a key
        return LineIndex(self.postings, counts, store(build_filters(counts, bits), "line-filters"), bits, self.signed)

    @staticmethod
    def _net(postings: DataFrame) -> DataFrame:
        """Rows that remain when signs are summed, per document row and key."""
        return (
            postings.groupBy("hi", "lo", "doc", "row").agg(F.sum(F.col("lines") * F.col("sign")).cast("int").alias("lines")).where("lines > 0")
        )

    def live(self, postings: DataFrame | None = None) -> DataFrame:
        """Postings in force. Without deletions every written row is."""
        postings = self.postings if postings is None else postings
        return self._net(postings) if self.signed else postings

    def reference_counts(self, live: DataFrame) -> DataFrame:
        """``hi``, ``lo``, ``refs`` (lines), ``first_doc`` and ``last_doc``:
        grouped sums, minima and maxima, combined before the shuffle."""
        return live.groupBy("hi", "lo").agg(
            F.sum("lines").alias("refs"), F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc")
        )

    def drops(self) -> DataFrame:
        """``doc``, ``row``, ``keys``: per document row the line keys it loses."""
        likely = probe_filters(self.live(), self.filters, self.counts, self.bits)
        exact = likely.join(self.counts.select("hi", "lo", "first_doc"), ["hi", "lo"]).where(F.col("doc") > F.col("first_doc"))
        # grouped per document row, so bounded by its lines; equal rows of an id list a key once
        return exact.groupBy("doc", "row").agg(F.collect_set(F.struct("hi", "lo")).alias("keys"))


def numbered(docs: DataFrame) -> DataFrame:
    """Documents with the ``doc`` and ``row`` of their postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches):
            doc = [NULL_ID if x is None else x for x in batch.column("doc_id").to_pylist()]
            row = pa.array([row_hash(t) for t in texts_of(batch)], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(doc, pa.int64()), row], names=["doc_id", "text", "doc", "row"])

    return documents_view(docs).mapInArrow(run, "doc_id long, text string, doc long, row int")


def dedup_lines(docs: DataFrame, index: LineIndex | None = None) -> DataFrame:
    """Per row of ``docs`` ``doc_id``, ``n_lines``, ``n_dropped`` and
    ``kept_text``. ``index`` (of these documents among others) is built from
    ``docs`` when not given."""
    index = index or LineIndex().insert(docs)
    drops = index.drops()
    joined = numbered(docs).join(drops, ["doc", "row"], "left").select("doc_id", "text", "keys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches):
            n_lines: list[int] = []
            n_dropped: list[int] = []
            kept: list[str] = []
            for text, keys in zip(texts_of(batch), batch.column("keys").to_pylist()):
                lines = text.split(b"\n")
                n_lines.append(len(lines))
                if keys:
                    gone = {np.array([k["hi"], k["lo"]], dtype="<i8").tobytes() for k in keys}
                    stay = [line for line, k in zip(lines, keyed_lines(text)) if k not in gone]
                    n_dropped.append(len(lines) - len(stay))
                    text = b"\n".join(stay)
                else:
                    n_dropped.append(0)
                kept.append(text.decode())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64()), "kept_text": pa.array(kept, pa.string()),
            })

    return joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_text string")
