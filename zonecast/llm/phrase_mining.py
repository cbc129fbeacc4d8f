"""Collocations: frequent phrases whose words keep company, per language.

1. Texts become segments, each of one language: a dictionary of its words and
   the text as numbers of that dictionary, 0 where a piece ends. Segments are
   written once; every later pass reads them, not the texts.
2. Candidates, length by length. A phrase of k words can only be frequent if
   the k - 1 words at either end of it are (Apriori), so a segment counts a
   phrase by its 64-bit hash only if both may be: frequent hashes are marked in
   a bit set of fixed size, which can admit too much but never leaves a
   frequent phrase out. Hash counts are summed by a grouped aggregate; what
   reaches the threshold is a candidate (equal hashes only add up, so no
   frequent phrase is missed) and one of its segments names its words. Hashes
   travel packed, a segment's sorted hashes of one range as one row; a range
   is as wide as ``PART_WORDS`` words of text need, whatever the corpus.
3. Candidates are dealt to slices of about ``TRIE_PHRASES`` by hash; a task
   builds a double-array trie for each. Slice by slice the trie is broadcast
   (its size is bounded by the slice, whatever the corpus) and every segment
   advances the states of all its positions together, level by level in NumPy,
   counting accepting states; counts of a task's segments are added up, then
   those of all tasks by a grouped sum. These are the counts used.
4. Cuts, containment and ranks are joins and aggregates; scores are computed in
   decimals.

A word is coded as a few symbols, so no node has more than ``SYMBOLS`` children.
Words are told apart by 64-bit hashes. Hot words and phrases are counted in the
segment before anything is shuffled.

Defined results: a null language is ``und``; null and empty texts have no words;
ids play no part, so every row counts. No words: no rows. Ties go by score, then
frequency, then the phrase's bytes. Very long texts are worked on whole. Other
columns are left out.
"""
from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.llm.common import HashTable, arrow_rows, byte_slices, gathered, hash_ranges, hashes_of, released, store

MIN_COUNT = 10
MAX_WORDS = 3
KEEP = 2000
#: A phrase goes if a longer one has at least this percentage of its count.
COVERED = 50

#: Bits of the sets that mark frequent hashes: 16 MB each.
BITS = 27
#: Phrases of a trie, about 25 MB when built.
TRIE_PHRASES = 1 << 19
#: Words of text for each range of hashes that is summed in one task.
PART_WORDS = 1 << 22
#: Texts and segments that a worker gets at once.
TEXT_ROWS, SEGMENT_ROWS = 1 << 9, 1 << 2
#: Positions of a segment that are worked on at once.
BLOCK = 1 << 17
#: Symbols of a word's code, a power of two.
SYMBOLS = 64

SPACES, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
SEGMENT = "seg int, lang string, n long, words array<string>, counts array<long>, codes binary"


def mine_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, keep: int = KEEP, covered: int = COVERED) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a`` (its count), ``l`` and ``r`` (the
    counts of its parts at the cut of the lowest score), ``n`` (words of the
    language), ``score`` = floor(10^6 a^2 / (l r)): the ``keep`` best phrases
    of 2 to ``max_words`` words and at least ``min_count`` occurrences, without
    those that lie in a longer one of ``covered`` percent of their count."""
    if min_count < 1 or max_words < 2:
        raise ValueError("phrases have two words and one occurrence at least")
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        segments = store(encode_texts(docs), "segments")
    with arrow_rows(docs.sparkSession, SEGMENT_ROWS):
        candidates = find_candidates(segments, min_count, max_words)
    counts = store(count_candidates(segments, candidates, max_words).where(F.col("f") >= min_count), "counts")
    return rank_phrases(segments, counts, keep, covered)


# ---- segments ----------------------------------------------------------------
def encode_texts(docs: DataFrame) -> DataFrame:
    """Segments of about 8 MB of text; ``n`` counts a segment's words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(byte_slices(gathered(batches))):
            yield segments_of(batch.column("lang"), batch.column("text"))

    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(work, SEGMENT)


def byte_classes() -> np.ndarray:
    """0 for a byte of a word, 1 for a space, 2 for the end of a piece."""
    out = np.zeros(256, dtype=np.int8)
    out[list(SPACES)] = 1
    out[list(BREAKS)] = 2
    return out


def split_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, A-Z lower-cased, with begin, length, text and piece (the
    number of ends before it) of each word."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    kind = byte_classes()[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    starts, ends = kind == 0, kind == 0
    starts[1:] &= (kind[:-1] != 0) | edge[1:-1]
    ends[:-1] &= (kind[1:] != 0) | edge[1:-1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    piece = np.searchsorted(np.flatnonzero(kind == 2), begin)
    text = np.searchsorted(offsets, begin, "right") - 1
    return np.concatenate((fold[raw], np.zeros(8, np.uint8))), begin, end - begin, text, piece


def segments_of(langs: pa.Array, column: pa.Array) -> pa.RecordBatch:
    """One segment for each language of the texts."""
    data, begin, length, text, piece = split_words(column)
    hashes = hash_ranges(data, begin, length)
    names = langs.dictionary_encode()
    which = names.indices.to_numpy()[text] if len(text) else text
    out: list[list] = [[], [], [], [], [], []]
    for number, lang in enumerate(names.dictionary.to_pylist()):
        mine = np.flatnonzero(which == number)
        if not len(mine):
            continue
        distinct, first, code, count = np.unique(hashes[mine], return_index=True, return_inverse=True, return_counts=True)
        new = np.flatnonzero((np.diff(piece[mine]) > 0) | (np.diff(text[mine]) > 0)) + 1
        codes = np.insert(code.astype(np.uint32) + 1, new, 0)
        first = mine[first]
        words = [data[a:a + n].tobytes() for a, n in zip(begin[first].tolist(), length[first].tolist())]
        # a number that tells segments apart, drawn from what the segment holds
        seg = zlib.crc32(codes.tobytes(), zlib.crc32(distinct.tobytes())) >> 1
        narrow = codes.astype(np.uint16) if len(distinct) < 1 << 16 else codes
        for values, value in zip(out, (seg, lang, len(mine), pa.array(words, pa.binary()).cast(pa.string()), count, narrow.tobytes())):
            values.append(value)
    words = pa.ListArray.from_arrays(np.cumsum([0, *map(len, out[3])]).astype(np.int32), pa.concat_arrays([*out[3], pa.array([], pa.string())]))
    columns = [pa.array(out[0], pa.int32()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64()), words, pa.array(out[4], pa.list_(pa.int64())), pa.array(out[5], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["seg", "lang", "n", "words", "counts", "codes"])


class Segment:
    """A row of the segments: ``codes`` of its positions (0: end of a piece)
    and ``hashes`` of its words, by code (none for 0)."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        self.seg, self.lang = batch.column("seg")[i].as_py(), batch.column("lang")[i].as_py()
        self.words = batch.column("words")[i].values
        self.hashes = np.append(np.uint64(0), array_hashes(self.words))
        kind = np.uint16 if len(self.words) < 1 << 16 else np.uint32
        self.codes = np.frombuffer(batch.column("codes")[i].as_buffer(), kind).astype(np.int32)
        self.counts = batch.column("counts")[i].values.to_numpy() if "counts" in batch.schema.names else None


def array_hashes(words: pa.Array) -> np.ndarray:
    """The hashes that ``hash_ranges`` gives the words of a column."""
    _, offsets, data = words.cast(pa.string()).buffers()
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    offsets = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.concatenate((np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], np.zeros(8, np.uint8)))
    return hash_ranges(data, offsets[:-1] - offsets[0], np.diff(offsets))


def mixed(hashes: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The hash of a sequence from that of its first part and what follows."""
    h = (hashes * np.uint64(0x9E3779B97F4A7C15)) ^ more
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def phrase_hashes(segment: Segment, k: int, bits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the phrases of ``k`` words that may be frequent
    by the bit sets of shorter ones."""
    lang = np.full(1, hashes_of([segment.lang.encode()])[0])
    of_word = mixed(np.broadcast_to(lang, len(segment.hashes)), segment.hashes)
    found = []
    for begin in range(0, len(segment.codes), BLOCK):
        # a phrase that begins in the block ends k - 1 positions behind it at most
        codes = segment.codes[begin:begin + BLOCK + k - 1]
        at = np.flatnonzero(codes)
        hashes = of_word[codes[at]]
        for size in range(2, k + 1):
            held = has_bits(bits[size - 2], hashes)
            at, hashes = at[held], hashes[held]
            # the phrase without its first word begins at the next position
            follows = np.flatnonzero(at[1:] == at[:-1] + 1) if len(at) else at
            at = at[follows]
            hashes = mixed(hashes[follows], segment.hashes[codes[at + size - 1]])
        mine = at < BLOCK
        found.append((at[mine] + begin, hashes[mine]))
    at, hashes = zip(*found) if found else ([np.zeros(0, np.int64)], [np.zeros(0, np.uint64)])
    return np.concatenate(at), np.concatenate(hashes)


# ---- candidates --------------------------------------------------------------
def has_bits(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - BITS)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 != 0


def bit_set(hashes: DataFrame) -> np.ndarray:
    """A bit for each value of the leading ``BITS`` bits of ``h``; at most
    2^BITS bits reach the driver, however many hashes there are."""
    place = F.shiftrightunsigned("h", 64 - BITS) + 1
    parts = hashes.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("held")).toArrow()
    out = np.zeros(max(1 << (BITS - 3), 4096), dtype=np.uint8)
    for part, held in zip(parts.column("part").to_pylist(), parts.column("held").to_pylist()):
        out[4096 * (part - 1):4096 * part] = np.frombuffer(held, np.uint8)
    return out


def find_candidates(segments: DataFrame, min_count: int, max_words: int) -> DataFrame:
    """``lang``, ``phrase`` (its words joined by a space): all phrases of up to
    ``max_words`` words that occur ``min_count`` times, and rarely one that
    does not but shares its hash."""
    parts = max(1, -(-(segments.agg(F.sum("n")).first()[0] or 0) // PART_WORDS))
    bits: list[bytes] = []
    levels = []
    for k in range(1, max_words + 1):
        frequent = frequent_hashes(segments, bits, k, min_count, parts)
        levels.append(frequent.withColumn("k", F.lit(k)))
        if k < max_words:
            bits.append(bit_set(frequent).tobytes())
    return name_phrases(segments, reduce(DataFrame.unionByName, levels), bits)


def frequent_hashes(segments: DataFrame, bits: list[bytes], k: int, min_count: int, parts: int) -> DataFrame:
    """``h`` and ``seg`` (one of its segments, drawn by the hash) of the
    phrases of ``k`` words whose hash occurs ``min_count`` times; stored."""
    shared = segments.sparkSession.sparkContext.broadcast(bits)
    kind = np.uint8 if min_count < 256 else np.uint32  # beyond the threshold a count need not be exact here

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [np.frombuffer(b, np.uint8) for b in shared.value]
        for batch in released(batches):
            for i in range(batch.num_rows):
                segment = Segment(batch, i)
                if k == 1:
                    lang = np.full(len(segment.words), hashes_of([segment.lang.encode()])[0])
                    distinct = mixed(lang, segment.hashes[1:])
                    order = np.argsort(distinct)
                    distinct, count = distinct[order], segment.counts[order]
                else:
                    distinct, count = np.unique(phrase_hashes(segment, k, bits)[1], return_counts=True)
                count = np.minimum(count, min_count).astype(kind)
                part = (distinct >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
                edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)] if len(part) else [0]
                ranges = list(zip(edges, edges[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(part[a]) for a, _ in ranges], pa.int64()), pa.array([segment.seg] * len(ranges), pa.int32()),
                        pa.array([distinct[a:b].tobytes() for a, b in ranges], pa.binary()), pa.array([count[a:b].tobytes() for a, b in ranges], pa.binary()),
                    ],
                    ["part", "seg", "hashes", "counts"],
                )

    def add_up(table: pa.Table) -> pa.Table:
        packed = [(np.frombuffer(h, np.uint64), np.frombuffer(c, kind), seg) for h, c, seg in zip(*(table.column(x).to_pylist() for x in ("hashes", "counts", "seg")))]
        hashes = np.concatenate([h for h, _, _ in packed])
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        total = np.add.reduceat(np.concatenate([c for _, c, _ in packed])[order], first, dtype=np.int64)
        often = np.flatnonzero(total >= min_count)
        held = np.diff(np.append(first, len(hashes)))[often]
        drawn = first[often] + (hashes[first[often]] % held.astype(np.uint64)).astype(np.int64)
        seg = np.repeat(np.array([s for _, _, s in packed], np.int32), [len(h) for h, _, _ in packed])[order[drawn]]
        return pa.table({"h": hashes[first[often]].view(np.int64), "seg": seg})

    packed = segments.drop("n").mapInArrow(pack, "part long, seg int, hashes binary, counts binary")
    frequent = store(packed.groupBy("part").applyInArrow(add_up, "h long, seg int"), f"frequent-{k}")
    shared.unpersist()
    return frequent


def name_phrases(segments: DataFrame, wanted: DataFrame, bits: list[bytes]) -> DataFrame:
    """The phrases of the wanted hashes, named by the segment drawn; stored."""
    shared = segments.sparkSession.sparkContext.broadcast(bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [np.frombuffer(b, np.uint8) for b in shared.value]
        for batch in released(batches):
            for i in range(batch.num_rows):
                segment = Segment(batch, i)
                asked = batch.column("asked")[i].values
                ks, hs = (asked.field(c).to_numpy(zero_copy_only=False) for c in ("k", "h"))
                for k in np.unique(ks).tolist():
                    at, hashes = phrase_hashes(segment, k, bits)
                    found, first = np.unique(hashes.view(np.int64), return_index=True)
                    at = at[first[np.isin(found, hs[ks == k])]]
                    parts = [segment.words.take(pa.array(segment.codes[at + j] - 1)) for j in range(k)]
                    named = parts[0] if k == 1 else pc.binary_join_element_wise(*parts, " ")
                    yield pa.RecordBatch.from_arrays([pa.array([segment.lang] * len(at), pa.string()), named], ["lang", "phrase"])

    lists = wanted.groupBy("seg").agg(F.collect_list(F.struct("k", "h")).alias("asked"))
    named = store(segments.drop("n", "counts").join(lists, "seg").mapInArrow(work, "lang string, phrase string").distinct(), "candidates")
    shared.unpersist()
    return named


# ---- tries -------------------------------------------------------------------
class DoubleArrayTrie:
    """Phrases as a double-array trie: from state ``s`` the symbol ``c`` leads
    to ``base[s] + c`` if ``check`` names ``s`` there. A word is ``digits``
    symbols; each language has a root. ``accept`` is the phrase's number, or
    -1."""

    def __init__(self, langs: pa.Array, phrases: pa.Array):
        """``phrases``: words joined by a space, with their languages."""
        lists = pc.split_pattern(phrases, " ")
        size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        words = lists.flatten().dictionary_encode()
        names = langs.dictionary_encode()
        self.digits = max(1, -(-max(len(words.dictionary) - 1, 0).bit_length() // (SYMBOLS.bit_length() - 1)))
        self.table = HashTable(max(len(words.dictionary), 1))
        self.table.put(array_hashes(words.dictionary), np.arange(len(words.dictionary)))
        self.roots = {lang: i for i, lang in enumerate(names.dictionary.to_pylist())}
        codes = words.indices.to_numpy().astype(np.int64)
        symbols = np.stack([self.digit(codes, d) for d in range(self.digits)], axis=1).ravel()
        self._fill(names.indices.to_numpy().astype(np.int64), size * self.digits, symbols)

    def digit(self, codes: np.ndarray, d: int) -> np.ndarray:
        """Symbol ``d`` of words by their codes, the highest first."""
        return codes // SYMBOLS ** (self.digits - 1 - d) % SYMBOLS

    def _fill(self, last: np.ndarray, size: np.ndarray, symbols: np.ndarray) -> None:
        start, nodes = np.cumsum(size) - size, len(self.roots)
        parents, symbol_of = [np.full(nodes, -1)], [np.zeros(nodes, np.int64)]
        for level in range(int(size.max(initial=0))):
            live = np.flatnonzero(size > level)
            key, inverse = np.unique(last[live] * SYMBOLS + symbols[start[live] + level], return_inverse=True)
            parents.append(key // SYMBOLS)
            symbol_of.append(key % SYMBOLS)
            last[live] = nodes + inverse
            nodes += len(key)
        slot, self.base, self.check = place_nodes(np.concatenate(parents), np.concatenate(symbol_of), len(self.roots))
        self.accept = np.full(len(self.check), -1, dtype=np.int32)
        self.accept[slot[last]] = np.arange(len(size))

    def to_bytes(self) -> bytes:
        """Plain arrays behind one another, last what says where they lie:
        workers need no installed copy of this class."""
        blobs: list[pickle.PickleBuffer] = []
        rest = pickle.dumps(self.__dict__ | {"table": self.table.__dict__}, protocol=5, buffer_callback=blobs.append)
        blobs = [b.raw() for b in blobs]
        head = pickle.dumps((rest, [len(b) for b in blobs]))
        return b"".join([*blobs, head, len(head).to_bytes(8, "little")])

    @classmethod
    def from_bytes(cls, data: bytes) -> DoubleArrayTrie:
        """The arrays are views of ``data``, which is not copied."""
        out, table = cls.__new__(cls), HashTable.__new__(HashTable)
        data = memoryview(data)
        rest, sizes = pickle.loads(data[-8 - int.from_bytes(data[-8:], "little"):-8])
        ends = np.cumsum(sizes).tolist()
        out.__dict__.update(pickle.loads(rest, buffers=[data[b - n:b] for b, n in zip(ends, sizes)]))
        table.__dict__.update(out.table)
        out.table = table
        return out

    def advance(self, at: np.ndarray, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All states go on with one word each (``codes``, none negative);
        those that the trie knows are left, with their ``at``."""
        for d in range(self.digits):
            to = self.base[states] + self.digit(codes, d)
            on = np.flatnonzero(self.check[to] == states)
            at, states, codes = at[on], to[on], codes[on]
        return at, states

    def matches(self, segment: Segment, max_words: int) -> np.ndarray:
        """The number of each phrase, as often as it occurs in the segment."""
        root = self.roots.get(segment.lang)
        if root is None:
            return np.zeros(0, dtype=np.int32)
        known = np.append(-1, self.table.get(segment.hashes[1:]))
        # the first word's states, once for each word of the segment
        words = np.flatnonzero(known >= 0)
        words, states = self.advance(words, np.full(len(words), root), known[words])
        after = np.full(len(known), -1)
        after[words] = states
        found = [np.zeros(0, dtype=np.int32)]
        for begin in range(0, len(segment.codes), BLOCK):
            codes = segment.codes[begin:begin + BLOCK + max_words - 1]
            code = np.append(known[codes], np.full(max_words - 1, -1))  # nothing follows the last word
            states = after[codes[:BLOCK]]
            at = np.flatnonzero(states >= 0)
            states = states[at]
            for length in range(1, max_words + 1):
                numbers = self.accept[states]
                found.append(numbers[numbers >= 0])
                if length < max_words:
                    live = code[at + length] >= 0
                    at, states = self.advance(at[live], states[live], code[at[live] + length])
        return np.concatenate(found)


def place_nodes(parents: np.ndarray, symbols: np.ndarray, roots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of the nodes and the two arrays. Parents of many children get a
    block of their own. The others are placed from more children to fewer, all
    of a size together: each draws a base, those whose slots are free and asked
    by nobody else stay, the rest draw again; the arrays grow when draws fail."""
    rng = np.random.default_rng(0)
    nodes = len(parents)
    children = np.argsort(parents, kind="stable")[roots:]  # the roots have no parent and come first
    owners, first, count = np.unique(parents[children], return_index=True, return_counts=True)
    many = np.flatnonzero(count >= SYMBOLS // 4)
    check = np.full(roots + SYMBOLS * (len(many) + 2) + 5 * nodes // 2, -1, dtype=np.int64)
    check[:roots] = -2
    slot = np.full(nodes, -1, dtype=np.int64)
    slot[:roots] = np.arange(roots)
    base_of = np.zeros(nodes, dtype=np.int64)

    def kids_of(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mine = np.repeat(np.arange(len(some)), count[some])
        return mine, children[np.arange(len(mine)) + np.repeat(first[some] - np.cumsum(count[some]) + count[some], count[some])]

    def put(some: np.ndarray, base: np.ndarray) -> None:
        mine, kids = kids_of(some)
        slot[kids] = base[mine] + symbols[kids]
        check[slot[kids]] = owners[some[mine]]
        base_of[owners[some]] = base

    put(many, roots + SYMBOLS * np.arange(len(many)))
    for size in range(SYMBOLS // 4 - 1, 0, -1):
        left, tries = np.flatnonzero(count == size), 0
        while len(left):
            base = rng.integers(roots, len(check) - SYMBOLS, len(left))
            mine, kids = kids_of(left)
            to = base[mine] + symbols[kids]
            claim = np.zeros(len(check), dtype=np.int32)
            claim[to] = mine
            bad = np.bincount(mine[(check[to] != -1) | (claim[to] != mine)], minlength=len(left)) > 0
            put(left[~bad], base[~bad])
            left, tries = left[bad], tries + 1
            if tries % 64 == 0:
                check = np.append(check, np.full(len(check) // 4, -1))
    taken = check >= 0
    check[taken] = slot[check[taken]]
    base = np.zeros(len(check), dtype=np.int32)
    base[slot] = base_of
    return slot, base, check.astype(np.int32)


def count_candidates(segments: DataFrame, candidates: DataFrame, max_words: int) -> DataFrame:
    """``lang``, ``phrase``, ``f``: how often each candidate occurs."""
    spark = segments.sparkSession
    slices = max(1, -(-candidates.count() // TRIE_PHRASES))
    order = Window.partitionBy("slice").orderBy("lang", "phrase")
    dealt = candidates.withColumn("slice", F.pmod(F.xxhash64("lang", "phrase"), F.lit(slices)).cast("int"))
    dealt = store(dealt.withColumn("id", F.row_number().over(order) - 1), "dealt")
    tries = store(dealt.groupBy("slice").applyInArrow(build_trie, "slice int, trie binary"), "tries")
    counts = [trie_counts(spark, segments, tries.where(F.col("slice") == i), max_words).withColumn("slice", F.lit(i)) for i in range(slices)]
    summed = reduce(DataFrame.unionByName, counts).groupBy("slice", "id").agg(F.sum("n").alias("f"))
    return dealt.join(summed, ["slice", "id"]).select("lang", "phrase", "f")


def build_trie(table: pa.Table) -> pa.Table:
    """One slice's trie; the phrase ``id`` has the number ``id``."""
    table = table.sort_by("id").combine_chunks()
    lang, phrase = (pa.concat_arrays(table.column(c).chunks) for c in ("lang", "phrase"))
    trie = DoubleArrayTrie(lang, phrase).to_bytes()
    pa.default_memory_pool().release_unused()
    return pa.table({"slice": table.column("slice")[:1], "trie": pa.array([trie], pa.binary())})


def trie_counts(spark: SparkSession, segments: DataFrame, row: DataFrame, max_words: int) -> DataFrame:
    """``id``, ``n``: counts of one slice's phrases, added up in each task."""
    held = row.select("trie").toArrow().column("trie").to_pylist()
    shared = spark.sparkContext.broadcast(held[0] if held else None)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value is None:
            return
        trie = DoubleArrayTrie.from_bytes(shared.value)
        counts = np.zeros(int(trie.accept.max()) + 1, dtype=np.int64)
        for batch in released(batches):
            for i in range(batch.num_rows):
                counts += np.bincount(trie.matches(Segment(batch, i), max_words), minlength=len(counts))
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts[found])], ["id", "n"])

    with arrow_rows(spark, SEGMENT_ROWS):
        counted = store(segments.drop("n", "counts").mapInArrow(work, "id int, n long"), "trie-counts")
    shared.unpersist()
    return counted


# ---- scores ------------------------------------------------------------------
def rank_phrases(segments: DataFrame, counts: DataFrame, keep: int, covered: int) -> DataFrame:
    """Cuts, containment and the best of each language."""
    words = F.split("phrase", " ")
    sized = counts.withColumns({"words": words, "k": F.size(words)})
    phrases = sized.where(F.col("k") > 1).withColumnRenamed("f", "a")
    part = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = phrases.select("lang", "phrase", "a", "words", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    cuts = cuts.withColumns({"top": wide("a") * wide("a") * F.lit(1_000_000).cast("decimal(7,0)"), "low": wide("l") * wide("r")})
    cuts = cuts.withColumn("score", F.expr("top div low"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    # the most frequent longer phrase around each shorter one
    inner = phrases.where(F.col("k") > 2).select("lang", "a", "words", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inner = inner.select("lang", "a", "words", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("start"))
    around = inner.groupBy("lang", part(F.col("start"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= keep)
    totals = segments.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "best.l", "best.r", "n", "best.score")
