"""Token ids in Simple-8b word-aligned shards.

Format of a shard (little-endian):

    magic  4 bytes "ZS8B" | version u32 | ids u64 | block size u32
    | blocks u32 | words u64 | escapes u64
    block offsets u32[blocks + 1]   first word of each block
    words         u64[words]        selector in the top 4 bits, payload below
    escapes       u64[escapes]      values of more than 60 bits

A word's selector s says that its payload holds ``COUNTS[s]`` values of
``WIDTHS[s]`` bits, the first in the lowest bits; selector 15 is the escape,
whose payload is a place in the escape table. Words never cross a block of
``BLOCK`` ids, so any block decodes alone from its offset, and all words with
the same selector decode in one NumPy expression.

Defined cases: a null or empty text is one document holding just the end id;
documents are written in ascending id (null last), repeated rows one after
another; an empty table writes no shard and yields no row; other columns of
the input are ignored.
"""
from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import NULL_ID, HashTable, Words, byte_slices, documents_view, hashes_of, store, worker_cache

#: Fixed values of the format: values per word and bits per value by selector.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15
BLOCK = 128
MAGIC = b"ZS8B"
HEADER = "<4sIQIIQQ"
#: A shard is closed at the first document end after so many ids.
SHARD_IDS = 1 << 19
#: Distinct words and pieces a Python worker remembers (about 80 bytes each)
#: before it starts anew.
CACHE_PIECES = 1_500_000


def bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each unsigned value, at least 1."""
    if not len(values):
        return np.zeros(0, dtype=np.uint8)
    if values.max() < 1 << 16:
        table = np.maximum(np.frexp(np.arange(1 << 16, dtype=np.float64))[1], 1).astype(np.uint8)
        return table[values]
    high = values >> np.uint64(30)
    low_bits = np.frexp((values & np.uint64((1 << 30) - 1)).astype(np.float64))[1]
    high_bits = np.frexp(high.astype(np.float64))[1]
    return np.maximum(np.where(high > 0, high_bits + 30, low_bits), 1).astype(np.uint8)


def encode_shard(values: np.ndarray, block: int = BLOCK) -> bytes:
    """Pack unsigned values; each word takes as many as fit (greedy). All
    blocks advance together, one word per step."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    blocks = -(-n // block)
    pad = max(COUNTS)
    full = np.zeros(blocks * block + pad, dtype=np.uint64)
    full[:n] = values
    bits = np.zeros((blocks, block + pad), dtype=np.uint8)  # nothing stands behind a block's end
    whole = np.zeros(blocks * block, dtype=np.uint8)
    whole[:n] = bit_lengths(values)
    bits[:, :block] = whole.reshape(blocks, block)
    best = np.full((blocks, block), len(COUNTS) - 1, dtype=np.int8)
    reach, sized = bits, 1  # reach[:, p]: bits of the widest of `sized` values from p
    for s in range(len(COUNTS) - 2, -1, -1):
        count = COUNTS[s]
        while sized < count:
            step = min(count - sized, sized)
            shifted = np.zeros_like(reach)
            shifted[:, :-step] = reach[:, step:]
            reach, sized = np.maximum(reach, shifted), sized + step
        best[reach[:, :block] <= WIDTHS[s]] = s
    best[bits[:, :block] > WIDTHS[-1]] = ESCAPE
    takes = np.array([*COUNTS, 0, 1], dtype=np.int64)
    lengths = np.full(blocks, block, dtype=np.int64)
    if blocks and n % block:
        lengths[-1] = n % block
    rows, at = np.arange(blocks), np.zeros(blocks, dtype=np.int64)
    used = np.zeros(blocks, dtype=np.int64)
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    while len(rows):
        pos = at[rows]
        chosen = best[rows, pos]
        steps.append((rows, pos, chosen, used[rows]))
        used[rows] += 1
        at[rows] = pos + takes[chosen]
        rows = rows[at[rows] < lengths[rows]]
    offsets = np.zeros(blocks + 1, dtype=np.uint32)
    np.cumsum(used, out=offsets[1:])
    words = np.zeros(int(offsets[-1]), dtype=np.uint64)
    escapes = np.zeros(0, dtype=np.uint64)
    if steps:
        row, pos, chosen, nth = (np.concatenate(x) for x in zip(*steps))
        place = offsets[row].astype(np.int64) + nth
        for s, (count, width) in enumerate(zip(COUNTS, WIDTHS)):
            of = np.flatnonzero(chosen == s)
            if len(of):
                first, room = row[of] * block + pos[of], lengths[row[of]] - pos[of]
                word = np.full(len(of), s << 60, dtype=np.uint64)
                for k in range(count):  # what stands behind the block's end belongs to the next
                    word |= np.where(k < room, full[first + k], np.uint64(0)) << np.uint64(k * width)
                words[place[of]] = word
        of = np.flatnonzero(chosen == ESCAPE)
        if len(of):
            of = of[np.argsort(place[of])]
            escapes = full[row[of] * block + pos[of]]
            words[place[of]] = np.arange(len(of), dtype=np.uint64) | np.uint64(ESCAPE << 60)
    head = struct.pack(HEADER, MAGIC, 1, n, block, blocks, len(words), len(escapes))
    return b"".join((head, offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()))


def _parts(image: bytes):
    magic, version, n, block, blocks, n_words, n_escapes = struct.unpack_from(HEADER, image)
    if magic != MAGIC or version != 1:
        raise ValueError("not a Simple-8b shard of version 1")
    a = struct.calcsize(HEADER)
    offsets = np.frombuffer(image, "<u4", blocks + 1, a)
    words = np.frombuffer(image, "<u8", n_words, a := a + 4 * (blocks + 1))
    escapes = np.frombuffer(image, "<u8", n_escapes, a + 8 * n_words)
    return n, block, offsets, words, escapes


def decode_shard(image: bytes, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """Values of the blocks ``first_block`` up to ``last_block`` (all by
    default); only their words are touched."""
    n, block, offsets, words, escapes = _parts(image)
    last = len(offsets) - 1 if last_block is None else min(last_block, len(offsets) - 1)
    if last <= first_block:
        return np.zeros(0, dtype=np.uint64)
    offsets = offsets[first_block:last + 1].astype(np.int64)
    words = words[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    size = min(n, last * block) - first_block * block
    chosen = (words >> np.uint64(60)).astype(np.int64)
    takes = np.array([*COUNTS, 0, 1], dtype=np.int64)[chosen]
    of_block = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    before = np.concatenate(([0], np.cumsum(takes)[:-1]))
    at = before - before[offsets[:-1]][of_block]  # first value of the word within its block
    room = np.minimum(block, size - of_block * block) - at
    payload = words & np.uint64((1 << 60) - 1)
    out = np.zeros(size, dtype=np.uint64)
    for s, (count, width) in enumerate(zip(COUNTS, WIDTHS)):
        of = np.flatnonzero(chosen == s)
        if len(of):
            nth = np.arange(count)
            got = (payload[of, None] >> (nth.astype(np.uint64) * np.uint64(width))) & np.uint64((1 << width) - 1)
            real = nth[None, :] < room[of, None]
            out[((of_block[of] * block + at[of])[:, None] + nth)[real]] = got[real]
    of = np.flatnonzero(chosen == ESCAPE)
    if len(of):
        out[of_block[of] * block + at[of]] = escapes[payload[of].astype(np.int64)]
    return out


class PieceTable:
    """Ids of distinct pieces by the piece's hash, one after another in one
    array."""

    def __init__(self, capacity: int):
        self.numbers = HashTable(capacity)
        self.count = self.used = 0
        self.begin = np.zeros(1 << 12, dtype=np.int64)
        self.length = np.zeros(1 << 12, dtype=np.int64)
        self.ids = np.zeros(1 << 14, dtype=np.uint32)

    def add(self, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        n, m = self.count, len(hashes)
        while n + m > len(self.begin):
            self.begin, self.length = np.resize(self.begin, 2 * len(self.begin)), np.resize(self.length, 2 * len(self.length))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.numbers.put(hashes, np.arange(n, n + m))
        self.length[n:n + m] = lengths
        self.begin[n:n + m] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used:self.used + len(ids)] = ids
        self.count, self.used = n + m, self.used + len(ids)

    def expand(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sequence of pieces, and how many each has."""
        lengths = self.length[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.begin[codes] - (ends - lengths), lengths) + np.arange(total)], lengths


def word_encoder(path: str):
    """``texts (an Arrow column) -> (ids, ids per text)``, equal to encoding
    each whole text with the tokenizer file at ``path`` without special tokens
    around it.

    The tokenizer drops white space, lower-cases, and always splits between an
    ASCII letter or digit and ASCII punctuation (unless an apostrophe is
    near), so ids of a piece cut there do not depend on its neighbours:
    distinct pieces are encoded once per worker, many in one call with a
    special token between them, words are put together from pieces and texts
    from words. A table that is full starts anew. Texts that may hold a
    special token's string are encoded directly.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    cache = worker_cache(("token pieces", path))
    if not cache:
        cache["tokenizer"], cache["pieces"] = Tokenizer.from_file(path), PieceTable(CACHE_PIECES)
    tokenizer = cache["tokenizer"]
    between_id, between = next((i, t.content) for i, t in sorted(tokenizer.get_added_tokens_decoder().items()) if t.special)
    runs = re.compile(rb"[a-z0-9]+|[^a-z0-9\x20\x09-\x0d]+").findall
    cut = re.compile(rb"(?<=[a-z])(?=[.,](?:[\x20\x09-\x0d]|\Z))").sub

    def encoded(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        groups = [between.join([p.decode() for p in pieces[i:i + 500]]) for i in range(0, len(pieces), 500)]
        parts, counts = [], []
        for enc in tokenizer.encode_batch(groups, add_special_tokens=False):
            ids = np.array(enc.ids, dtype=np.uint32)
            marks = np.flatnonzero(ids == between_id)
            counts.append(np.diff(np.concatenate(([-1], marks, [len(ids)]))) - 1)
            parts.append(ids[ids != between_id])
        return np.concatenate(parts), np.concatenate(counts)

    def learn(table: PieceTable, hashes: np.ndarray, words: list[bytes]) -> None:
        """Add missing words (distinct), put together from pieces."""
        parts = [runs(w) if w.isascii() and b"'" not in w else cut(b" ", w).split() for w in words]
        flat = [x for own in parts for x in own]
        keys = hashes_of(flat)
        missing = np.flatnonzero(table.numbers.get(keys) < 0)
        if len(missing):
            new, first = np.unique(keys[missing], return_index=True)
            table.add(new, *encoded([flat[i] for i in missing[first].tolist()]))
        ids, lengths = table.expand(table.numbers.get(keys))
        n = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        several = n > 1  # the others are their only piece
        keep = np.repeat(several, n)
        of = np.repeat(np.cumsum(several) - 1, n)[keep]
        table.add(
            hashes[several], ids[np.repeat(keep, lengths)],
            np.bincount(of, weights=lengths[keep], minlength=int(several.sum())).astype(np.int64),
        )

    def encode(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        special = pc.match_substring(column, "<|").to_numpy(zero_copy_only=False)
        if special.any():
            plain = pc.if_else(pa.array(special), "", column)
        else:
            plain = column
        words = Words(plain, lower=True)
        if cache["pieces"].count > CACHE_PIECES:
            cache["pieces"] = PieceTable(CACHE_PIECES)
        table = cache["pieces"]
        codes = table.numbers.get(words.hashes)
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            new, first = np.unique(words.hashes[missing], return_index=True)
            learn(table, new, [words.word(i) for i in missing[first].tolist()])
            codes[missing] = table.numbers.get(words.hashes[missing])
        ids, lengths = table.expand(codes)
        edges = np.concatenate(([0], np.cumsum(lengths)))[words.starts]
        if not special.any():
            return ids, np.diff(edges)
        split = np.split(ids, edges[1:-1])
        for i in np.flatnonzero(special).tolist():
            split[i] = np.array(tokenizer.encode(column[i].as_py(), add_special_tokens=False).ids, dtype=np.uint32)
        return np.concatenate(split), np.fromiter(map(len, split), dtype=np.int64, count=len(split))

    return encode


SHARD_SCHEMA = "part int, seq int, doc_ids array<long>, lengths array<long>, n_ids long, image binary"


def write_token_shards(docs: DataFrame, tokenizer_path: str, end_id: int, *, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode every text, append ``end_id``, write shards in ascending id.

    The texts are dealt once by ranges of the id and sorted within; a task
    then streams its range and closes a shard every ``shard_ids`` ids, so
    memory is bounded by a shard and the longest document. Spark's committed
    write keeps shards whole when tasks are repeated. Returns the written
    table, one row per shard, ordered by ``part``, ``seq``.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        run = word_encoder(tokenizer_path)
        ids: list[np.ndarray] = []
        lengths: list[int] = []
        doc_ids: list[int | None] = []
        seq = held = 0

        def shard():
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())), "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "n_ids": pa.array([held], pa.int64()), "image": pa.array([encode_shard(np.concatenate(ids))], pa.binary()),
            })

        for batch in byte_slices(batches, limit=2 << 20):
            flat, counts = run(batch.column("text"))
            ends = np.cumsum(counts)
            ids.append(np.insert(flat, ends, end_id))  # after each document
            lengths += (counts + 1).tolist()
            doc_ids += batch.column("doc_id").to_pylist()
            held += len(flat) + len(counts)
            if held >= shard_ids:
                yield shard()
                ids, lengths, doc_ids, held, seq = [], [], [], 0, seq + 1
        if ids:
            yield shard()

    order = F.coalesce("doc_id", F.lit(NULL_ID))
    dealt = documents_view(docs).withColumn("_zc_order", order).repartitionByRange("_zc_order")
    dealt = dealt.sortWithinPartitions("_zc_order", "text").select("doc_id", "text")
    return store(dealt.mapInArrow(encode, SHARD_SCHEMA), "token-shards")


def read_token_shards(shards: DataFrame) -> DataFrame:
    """Decode written shards: per document its place in the whole sequence,
    its number of ids and their CRC-32 as unsigned 32-bit integers.

    Places come from sums: shards within a part, then parts (one row each,
    their number is that of write tasks).
    """
    sizes = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = sizes.select(
        "part", (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before")
    )
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    places = (
        shards.select("part", "seq", "n_ids")
        .withColumn("within", F.sum("n_ids").over(in_part) - F.col("n_ids"))
        .join(parts, "part")
        .select("part", "seq", (F.col("before") + F.col("within")).alias("shard_start"))
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                ids = decode_shard(one["image"]).astype("<u4")
                lengths = np.array(one["lengths"], dtype=np.int64)
                ends = np.cumsum(lengths)
                view = memoryview(ids.tobytes())
                crcs = [zlib.crc32(view[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), lengths.tolist())]
                k = len(crcs)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([one["part"]] * k, pa.int32()), "seq": pa.array([one["seq"]] * k, pa.int32()),
                    "doc_id": pa.array(one["doc_ids"], pa.int64()), "local": pa.array(ends - lengths, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64()),
                })

    decoded = shards.select("part", "seq", "doc_ids", "lengths", "image").mapInArrow(
        decode, "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long"
    )
    return decoded.join(places, ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_token_ids(shards: DataFrame) -> DataFrame:
    """The decoded ids themselves: ``doc_id``, ``ids``."""

    def decode(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                ids = decode_shard(one["image"]).astype(np.int64)
                cuts = np.cumsum(one["lengths"])[:-1]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(one["doc_ids"], pa.int64()),
                    "ids": pa.array([x.tolist() for x in np.split(ids, cuts)], pa.list_(pa.int64())),
                })

    return shards.select("doc_ids", "lengths", "image").mapInArrow(decode, "doc_id long, ids array<long>")
