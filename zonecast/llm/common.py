"""Helpers shared by the corpus operators."""
from __future__ import annotations

import pickle
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.session import materialize

#: ASCII white space, the class ``[\x20\x09-\x0D]``; ``bytes.split()`` and
#: ``bytes.strip()`` use exactly this set, ``bytes.lower()`` changes A-Z only.
ASCII_SPACE = b" \t\n\x0b\x0c\r"

#: A null document id is one document that sorts after every other.
NULL_ID = 2**63 - 1


def documents_view(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` (long, may be null), ``text`` (null becomes empty) and the
    named extra columns; every other column is left out, so names of
    additional columns cannot clash with what the operators add."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *[F.col(name) for name in extra],
    )


def broadcast_object(spark: SparkSession, value):
    """Broadcast of a Python object with its class shipped by value; read it
    with ``broadcast_value``. The caller proves a bound on its size."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def broadcast_value(shared):
    return pickle.loads(shared.value)


def worker_cache(key) -> dict:
    """A dictionary that lives as long as the Python worker, so that tasks
    which follow in the same worker find what earlier ones computed. What is
    put in must be bounded and depend on ``key`` alone."""
    import sys
    import types

    home = sys.modules.setdefault("_corpus_worker_cache", types.ModuleType("_corpus_worker_cache"))
    return home.__dict__.setdefault(str(key), {})


def store(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` once to the shared folder and read it back: one pass
    over the input, lineage cut, sizes known to the planner."""
    return materialize(frame, name=f"llm-{name}")


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """While it lasts, the session has the setting; the one found is put back."""
    found = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if found is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, found)


def arrow_rows(spark: SparkSession, rows: int):
    """While it lasts, tables that are written hand their Python functions at
    most ``rows`` rows at once, so that few large rows do not pile up in the
    buffers of the JVM and of the worker."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def store_and_clean(frame: DataFrame, name: str) -> DataFrame:
    """``store``; the files of the shuffles that made the table go once it is
    written, not when the driver next collects its garbage."""
    with setting(frame.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        return store(frame, name)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; before the next is read, and after the last, Arrow's pool
    gives back what nothing uses: it would keep it as long as the worker lives."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def gathered(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches put together, in order, as long as ``column`` has no more
    than ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        own = pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if held and size + own > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        yield pa.concat_batches(held)


def byte_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Split Arrow batches so that ``column`` has about ``limit`` bytes in a
    slice (always one row at least); rows stay whole and in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // limit
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def hash_ranges(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges of ``data`` (which goes on for at least 8
    bytes behind the last range): equal bytes have equal hashes, eight bytes
    are mixed in at a time, all ranges together."""
    eights = np.lib.stride_tricks.as_strided(data.view(np.uint8), shape=(len(data) - 7, 8), strides=(1, 1)).view(np.uint64)[:, 0] if len(data) >= 8 else np.zeros(0, np.uint64)
    out = (length.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    at = np.arange(len(begin))
    done = 0
    while len(at):
        left = length[at] - done
        bits = (8 * np.minimum(left, 8)).astype(np.uint64)
        word = eights[begin[at] + done]
        word &= np.where(bits == 64, np.uint64(2**64 - 1), (np.uint64(1) << (bits & np.uint64(63))) - np.uint64(1))
        h = (out[at] ^ word) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        out[at] = h * np.uint64(0xBF58476D1CE4E5B9) ^ (h >> np.uint64(29))
        done += 8
        at = at[left > 8]
    return out


class Words:
    """The words of a column of texts without a Python object for each:
    ``hashes``, byte ranges (``begin``, ``length`` in ``data``) and where each
    text's words start (``starts``, one more than texts)."""

    def __init__(self, column: pa.Array, lower: bool = False, fold: bytes | None = None):
        """``lower`` folds A-Z; ``fold`` maps each byte first (256 bytes)."""
        column = column.cast(pa.string())
        if fold is not None and len(column):
            column = pc.fill_null(column, "")
            bits, offsets, data = column.buffers()
            mapped = np.frombuffer(fold, np.uint8)[np.frombuffer(data, np.uint8)] if data is not None else None
            column = pa.StringArray.from_buffers(len(column), offsets, mapped if mapped is None else pa.py_buffer(mapped), bits, -1, column.offset)
        lists = pc.ascii_split_whitespace(pc.fill_null(pc.ascii_lower(column) if lower else column, ""))
        flat = lists.flatten()
        offsets = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset:flat.offset + len(flat) + 1].astype(np.int64) if len(flat) else np.zeros(1, np.int64)
        length = np.diff(offsets)
        real = length > 0  # a text's white space at its ends splits off empty strings
        edges = lists.offsets.to_numpy().astype(np.int64) - (lists.offsets[0].as_py() if len(lists) else 0)
        self.starts = np.concatenate(([0], np.cumsum(real)))[edges]
        self.begin, self.length = offsets[:-1][real], length[real]
        raw = flat.buffers()[2] if len(flat) else None
        self.data = np.concatenate((np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8), np.zeros(8, np.uint8)))
        self.hashes = hash_ranges(self.data, self.begin, self.length)

    def word(self, i: int) -> bytes:
        a = int(self.begin[i])
        return self.data[a:a + int(self.length[i])].tobytes()


def hashes_of(words: list[bytes]) -> np.ndarray:
    """The hashes that ``Words`` gives these words."""
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    data = np.concatenate((np.frombuffer(b"".join(words), np.uint8), np.zeros(8, np.uint8)))
    return hash_ranges(data, np.cumsum(length) - length, length)


class HashTable:
    """From 64-bit hashes to numbers, in batches: open addressing, at most
    half full, doubled when needed."""

    def __init__(self, capacity: int):
        self._clear(max(8, (2 * capacity - 1).bit_length()))

    def _clear(self, bits: int) -> None:
        self.bits, self.shift, self.size = bits, np.uint64(64 - bits), 0
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.values = np.zeros(1 << bits, dtype=np.int32)

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash, -1 where it has none."""
        hashes = np.maximum(hashes, np.uint64(1))  # 0 marks a free slot
        slot = self._slot(hashes)
        held = self.keys[slot]
        out = np.where(held == hashes, self.values[slot], -1).astype(np.int64)
        on = np.flatnonzero((held != hashes) & (held != 0))
        while len(on):
            slot[on] = (slot[on] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[on]]
            same = held == hashes[on]
            out[on[same]] = self.values[slot[on[same]]]
            on = on[~same & (held != 0)]
        return out

    def put(self, hashes: np.ndarray, values: np.ndarray) -> None:
        """Add distinct hashes that are not in the table."""
        if 2 * (self.size + len(hashes)) > len(self.keys):
            held = np.flatnonzero(self.keys)
            keys, kept = self.keys[held], self.values[held]
            self._clear((2 * (len(held) + len(hashes))).bit_length())
            self.put(keys, kept)
        hashes = np.maximum(hashes, np.uint64(1))
        self.size += len(hashes)
        slot = self._slot(hashes)
        on = np.arange(len(hashes))
        while len(on):
            free = self.keys[slot[on]] == 0
            self.keys[slot[on[free]]] = hashes[on[free]]
            mine = free & (self.keys[slot[on]] == hashes[on])  # of several for one slot the last one has it
            self.values[slot[on[mine]]] = values[on[mine]]
            on = on[~mine]
            slot[on] = (slot[on] + 1) & (len(self.keys) - 1)
