"""SimHash near-duplicates, linked through pivot distance tables.

Fingerprints: 64 bits, one vote per word shingle. Links: fingerprints that
differ in at most ``max_bits`` bits. Only distinct fingerprints are compared
(copies collapse in a grouped minimum before), and only inside buckets: with
the 64 bits cut into ``max_bits + 2`` blocks, two fingerprints within
``max_bits`` bits agree on at least two whole blocks, so bucketing by every
pair of blocks misses no link. Within a bucket each fingerprint has a row in
a table of Hamming distances to ``PIVOTS`` reference fingerprints; by the
triangle inequality a pair whose coordinates differ by more than ``max_bits``
anywhere is discarded, the survivors are verified. A bucket is explored from
its smallest member against what is still unassigned, so a dense group of
near copies is absorbed in few steps and gives one link per member, never all
its pairs.

Defined cases: a null or empty text has the fingerprint zero and is linked
like any other; fewer words than a shingle give one shingle; repeated rows
share a fingerprint; rows with the same id are one document; each row with a
null id is a document of its own that sorts after all others (a component of
null ids only has a null component id); an empty table gives no rows; other
columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from zonecast.llm.common import byte_slices, documents_view, store, texts_of
from zonecast.llm.components import connected_components

#: Hash seed, shingle length and distance of the contract.
SEED = 42
SHINGLE = 3
MAX_BITS = 3
#: Reference fingerprints of the distance table.
PIVOTS = 16


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a text as an unsigned integer."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = (ends - lengths)[:len(words) - size + 1].tolist()
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begins, ends[size - 1:].tolist())]
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bounds the memory of the unpacked bits
        raw = np.array(hashes[i:i + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's 64 bits as a signed long) of
    every row, one pass without shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches):
            fps = np.array([simhash(t, shingle) for t in texts_of(batch)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(fps)})

    return documents_view(docs).mapInArrow(run, "doc_id long, fp long")


def pivot_fingerprints(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: a fixed pseudo-random set."""
    return np.random.default_rng(20240501).integers(0, 2**64, size=count, dtype=np.uint64)


def block_edges(blocks: int) -> list[tuple[int, int]]:
    """(shift, width) of ``blocks`` nearly equal runs of the 64 bits."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def bucket_rows(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``key``, ``fp``, ``node``: each fingerprint once for every pair of
    blocks."""
    blocks = block_edges(max_bits + 2)

    def part(edge):
        shift, width = edge
        return F.shiftrightunsigned(F.col("fp"), shift).bitwiseAND(F.lit((1 << width) - 1))

    keys = [
        F.shiftleft(F.shiftleft(part(a), b[1]).bitwiseOR(part(b)), 8).bitwiseOR(F.lit(i))
        for i, (a, b) in enumerate(combinations(blocks, 2))
    ]
    return distinct.select(F.explode(F.array(*keys)).alias("key"), "fp", "node")


def link_bucket(fps: np.ndarray, nodes: np.ndarray, pivots: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links (smaller node, node) that join what is within ``max_bits``,
    directly or in steps: one link for each member but a group's first."""
    order = np.argsort(nodes, kind="stable")
    fps, nodes = fps[order], nodes[order]
    table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)
    left = np.arange(len(fps))
    links: list[tuple[int, int]] = []
    while len(left) > 1:
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and len(left):
            at = frontier.pop()
            near = np.arange(len(left))
            for j in range(table.shape[1]):  # maximum coordinate difference, one coordinate at a time
                near = near[np.abs(table[left[near], j] - table[at, j]) <= max_bits]
                if not len(near):
                    break
            near = near[np.bitwise_count(fps[left[near]] ^ fps[at]) <= max_bits]
            if len(near):
                found = left[near]
                frontier += found.tolist()
                links += [(int(nodes[root]), int(x)) for x in nodes[found]]
                left = np.delete(left, near)
    return links


def fingerprint_links(distinct: DataFrame, *, max_bits: int = MAX_BITS, pivots: int = PIVOTS) -> DataFrame:
    """``u``, ``v``: links between the nodes of ``distinct`` (``fp``,
    ``node``) that connect all fingerprints within ``max_bits`` bits.

    Buckets stream through sorted partitions; a task holds one bucket.
    """
    references = pivot_fingerprints(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def links_of(keys, fps, nodes):
            edges = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
            out: list[tuple[int, int]] = []
            for k in np.flatnonzero(np.diff(edges) > 1):
                a, b = edges[k], edges[k + 1]
                out += link_bucket(fps[a:b], nodes[a:b], references, max_bits)
            return pa.RecordBatch.from_pydict({
                "u": pa.array([x for x, _ in out], pa.int64()), "v": pa.array([x for _, x in out], pa.int64())
            })

        for batch in batches:
            keys, fps, nodes = (batch.column(c).to_numpy() for c in ("key", "fp", "node"))
            fps = fps.view(np.uint64)
            if not len(keys):
                continue
            # what has the last key may go on in the next batch
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                whole = [*held, (keys[:cut], fps[:cut], nodes[:cut])]
                held = []
                yield links_of(*(np.concatenate(x) for x in zip(*whole)))
            elif held and held[-1][0][-1] != keys[0]:
                yield links_of(*(np.concatenate(x) for x in zip(*held)))
                held = []
            held.append((keys[cut:], fps[cut:], nodes[cut:]))
        if held:
            yield links_of(*(np.concatenate(x) for x in zip(*held)))

    rows = bucket_rows(distinct, max_bits).repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(run, "u long, v long").distinct()


def _components(docs: DataFrame, shingle: int, max_bits: int, pivots: int) -> tuple[DataFrame, DataFrame]:
    """The rows' ``doc_id`` and ``fp``, and for each distinct ``fp`` its ``group``
    (the smallest fingerprint that is linked, directly or in steps) and
    ``component_id``."""
    prints = store(fingerprints(docs, shingle=shingle).select("doc_id", "fp"), "fingerprints")
    distinct = store(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    links = fingerprint_links(distinct.select("fp", F.col("fp").alias("node")), max_bits=max_bits, pivots=pivots)
    # rows with one id but different texts are one document
    same_id = prints.join(_several(prints), "doc_id").select(F.col("a").alias("u"), F.col("fp").alias("v"))
    components = connected_components(links.unionByName(same_id))
    labels = store(distinct.join(components.withColumnRenamed("node", "fp"), "fp", "left"), "fingerprint-groups")
    linked = labels.where(F.col("component").isNotNull())
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = linked.join(least, "component").select("fp", F.col("component").alias("group"), "component_id")
    alone = labels.where(F.col("component").isNull()).select("fp", F.col("fp").alias("group"), F.col("least").alias("component_id"))
    return prints, linked.unionByName(alone)


def _several(prints: DataFrame) -> DataFrame:
    """``doc_id`` of the ids with more than one fingerprint, and the smallest, ``a``."""
    named = prints.where(F.col("doc_id").isNotNull())
    return named.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a != b").select("doc_id", "a")


def simhash_components(docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS, pivots: int = PIVOTS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``fp``, ``component_id`` (smallest
    ``doc_id`` that is linked, directly or in steps, itself included)."""
    prints, groups = _components(docs, shingle, max_bits, pivots)
    return prints.join(groups, "fp").select("doc_id", "fp", "component_id")


def _with_fingerprint(docs: DataFrame, shingle: int) -> DataFrame:
    """``docs`` with ``_zc_fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, column="_zc_fp"):
            fps = np.array([simhash(t, shingle) for t in texts_of(batch, "_zc_fp")], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps)], names=batch.schema.names)

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_zc_fp")
    return docs.select("*", text).mapInArrow(run, StructType([*docs.schema.fields, StructField("_zc_fp", LongType())]))


def keep_one_per_component(docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents that stay, all columns: of each component the row with
    the smallest id, once; of rows sharing that id, and of a component of null
    ids only, the row with the smallest fingerprint."""
    prints, groups = _components(docs, shingle, max_bits, PIVOTS)
    stay = prints.join(groups, "fp").where(F.col("doc_id") == F.col("component_id"))
    stay = store(stay.groupBy(F.col("doc_id").alias("_zc_id")).agg(F.min("fp").alias("_zc_fp"), F.max("fp").alias("_zc_last")), "kept-ids")
    keyed = docs.withColumn("_zc_id", F.col("doc_id").cast("long"))
    plain = stay.where("_zc_fp = _zc_last").select("_zc_id")
    parts = [keyed.join(plain, "_zc_id").dropDuplicates(["_zc_id"])]
    # only where the id does not tell the text are fingerprints computed again
    several = stay.where("_zc_fp != _zc_last").select("_zc_id", F.col("_zc_fp").alias("_zc_kept"))
    if not several.isEmpty():
        ids = keyed.join(several.select("_zc_id"), "_zc_id", "left_semi").select(*keyed.columns)
        again = _with_fingerprint(ids, shingle).join(several, "_zc_id")
        parts.append(again.where("_zc_fp = _zc_kept").dropDuplicates(["_zc_id"]))
    if not prints.where(F.col("doc_id").isNull()).isEmpty():
        kept = groups.where(F.col("component_id").isNull() & (F.col("fp") == F.col("group"))).select(F.col("fp").alias("_zc_fp"))
        nameless = _with_fingerprint(keyed.where(F.col("_zc_id").isNull()), shingle)
        parts.append(nameless.join(kept, "_zc_fp").dropDuplicates(["_zc_fp"]))
    columns = [f"`{c}`" for c in docs.columns]
    return reduce(DataFrame.unionByName, [part.select(*columns) for part in parts])
