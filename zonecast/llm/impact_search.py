"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Components become integers, ``floor(256 * x)``. Vectors are dealt evenly to
shards of at most ``SHARD`` rows. In a shard every dimension has its postings in
order of the component, cut into segments of about equal length that never part
equal components; a segment knows its smallest and largest component. For a
query the impact of a segment is the most that one of its members can get from
that dimension (the query's component times the segment's largest component, or
smallest if the query's is negative).

Segments are processed by descending impact, all members of a segment at once.
A vector's score is at most what it has been given plus, for each dimension in
which its segment is still to come, the impact of the next segment. The k best
by that bound (looked at after every ``GROUP`` segments a dimension) are scored
exactly, which gives a score that k vectors reach; a vector whose bound is below
it is proved out. Processing stops as soon as all but one in ``STOP`` are proved
out, or at the last segment, and whatever may still be among the k is scored
exactly, ties included. Results are exact for any data; the data only decide how
soon the proof is there.

Queries are a stated set of rows. They reach the shards in slices of at most
``QUERY_BYTES``, one broadcast each, so nothing broadcast grows with the data;
a shard returns k rows for each query, merged by a grouped top-k.

Defined results: a vector that is null or holds a null, NaN or infinite
component takes no part, nor does one with a component so large that sums of
impacts pass 64 bits (beyond 10^5 at 64 components). Missing components of shorter vectors count as zero. Equal
scores go by the smaller id, null ids last. Rows of one id are rows of their
own: only the query's own row is left out. Fewer candidates than k: all of
them. No vectors or no queries: no rows. Other columns are left out.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import broadcast_object, broadcast_value, store

SCALE = 256.0
#: Vectors of a shard: 4 MB of 64 components with their postings.
SHARD = 8192
#: Segments of a dimension in a shard.
SEGMENTS = 32
#: Segments, times the dimensions, between two looks at the bounds.
GROUP = 4
#: A query stops when at most one vector in so many is not proved out.
STOP = 8
QUERY_BYTES = 16 << 20

INDEX = "n long, rows binary, ids array<long>, vectors binary, members binary, cuts binary, low binary, high binary"
FOUND = "query_row long, query_id long, row long, vec_id long, score long"


def search_vectors(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id``, ``rank`` (int from 1), ``vec_id``, ``score``: for every
    row of ``vectors`` (``vec_id``, ``embedding``) that ``is_query`` names, the
    ``k`` other rows of the highest scores."""
    if k < 1:
        raise ValueError("k must be at least 1")
    base = store(integer_vectors(vectors, is_query), "vectors")
    n, width, asked = base.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.count_if("is_query")).first()
    index = store(build_index(base, n, width), "impact-index")
    slices = max(1, -(-asked * 4 * max(width, 1) // QUERY_BYTES))
    found = [
        search_slice(index, base.where(F.col("is_query") & (F.pmod(F.xxhash64("row"), F.lit(slices)) == i)), width, k)
        for i in range(slices)
    ]
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def integer_vectors(vectors: DataFrame, is_query: Column) -> DataFrame:
    """``row`` (its number), ``vec_id``, ``is_query`` and the integer
    components ``v`` of the rows that take part."""
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 1
    limit = float(min(math.isqrt((1 << 62) // (max(width, 1) << width.bit_length())), (1 << 31) - 1))
    scaled = F.transform("embedding", lambda x: F.lit(SCALE) * x.cast("double"))
    held = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("is_query"), scaled.alias("scaled")
    ).where(F.col("scaled").isNotNull() & F.forall("scaled", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < limit), F.lit(False))))
    return held.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "is_query", F.transform("scaled", lambda x: F.floor(x).cast("int")).alias("v")
    )


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists as rows of ``width`` integers, short ones filled with
    zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    offsets = column.offsets.to_numpy().astype(np.int64)
    size = np.diff(offsets)
    out = np.zeros((len(size), width), dtype=np.int32)
    within = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], size)
    out[np.repeat(np.arange(len(size)), size), within] = flat
    return out


def build_index(base: DataFrame, n: int, width: int) -> DataFrame:
    """One row per shard: its vectors and, for each dimension, the members in
    order of their components with the cuts and limits of the segments."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = SHARD - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == SHARD:
                    yield shard_of(held, width)
                    held = []
        if sum(b.num_rows for b in held):
            yield shard_of(held, width)

    return base.select("row", "vec_id", "v").repartition(max(1, -(-n // SHARD))).mapInArrow(work, INDEX)


def shard_of(batches: list[pa.RecordBatch], width: int) -> pa.RecordBatch:
    whole = pa.Table.from_batches(batches).combine_chunks()
    rows, ids, v = (whole.column(c).combine_chunks() for c in ("row", "vec_id", "v"))
    vectors = np.concatenate([matrix_of(x, width) for x in (v.chunks if isinstance(v, pa.ChunkedArray) else [v])])
    n = len(vectors)
    members = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)
    cuts = np.zeros((width, SEGMENTS + 1), dtype=np.int32)
    low, high = np.zeros((width, SEGMENTS), np.int32), np.zeros((width, SEGMENTS), np.int32)
    at = n * np.arange(SEGMENTS) // SEGMENTS
    for d in range(width):
        ordered = vectors[members[d], d]
        cuts[d] = np.append(np.searchsorted(ordered, ordered[at]), n)
        low[d] = ordered[np.minimum(cuts[d, :-1], n - 1)]
        high[d] = ordered[np.maximum(cuts[d, 1:] - 1, 0)]
    blobs = [np.asarray(rows).astype(np.int64), None, vectors, members, cuts, low, high]
    ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids if isinstance(ids, pa.Array) else pa.concat_arrays(ids.chunks))
    columns = [pa.array([n]), *[ids if b is None else pa.array([b.tobytes()], pa.binary()) for b in blobs]]
    return pa.RecordBatch.from_arrays(columns, ["n", "rows", "ids", "vectors", "members", "cuts", "low", "high"])


class Shard:
    """A shard of the index as arrays."""

    def __init__(self, columns: dict, width: int):
        take = lambda name, shape, kind=np.int32: np.frombuffer(columns[name], kind).reshape(shape)
        self.n, self.width, self.ids = columns["n"], width, columns["ids"]
        self.rows = take("rows", -1, np.int64)
        self.vectors = take("vectors", (self.n, width))
        self.members = take("members", (width, self.n)).astype(np.intp)
        self.cuts = take("cuts", (width, SEGMENTS + 1))
        self.low, self.high = (take(x, (width, SEGMENTS)).astype(np.int64) for x in ("low", "high"))
        self.id_order = np.array([2**63 - 1 if x is None else x for x in self.ids], dtype=np.int64)

    def search(self, query: np.ndarray, own: int, k: int, stop: int = STOP) -> tuple[np.ndarray, np.ndarray, int]:
        """The places and scores of the ``k`` best (``own`` is the query's row
        number) and the number of postings processed."""
        query = query.astype(np.int64)
        impact = np.where(query[:, None] > 0, query[:, None] * self.high, query[:, None] * self.low)
        used = (self.cuts[:, 1:] > self.cuts[:, :-1]) & (query[:, None] != 0)
        order = np.flatnonzero(used)[np.argsort(-impact[used], kind="stable")]
        # sum of impacts and, below it, how many segments have been seen
        given, bits = np.zeros(self.n, np.int64), self.width.bit_length()
        dims = int((query != 0).sum())
        mine = np.flatnonzero(self.rows == own)
        flat, starts, ends = impact.ravel(), self.cuts[:, :-1].ravel(), self.cuts[:, 1:].ravel()
        processed, least, exact = 0, None, {}
        possible = np.delete(np.arange(self.n), mine)
        for done in range(0, len(order), GROUP * self.width):
            group = order[done:done + GROUP * self.width]
            who = np.concatenate([self.members[g // SEGMENTS, a:b] for g, a, b in zip(group.tolist(), starts[group].tolist(), ends[group].tolist())])
            np.add.at(given, who, np.repeat((flat[group] << bits) + 1, ends[group] - starts[group]))
            processed += len(who)
            coming = flat[order[done + len(group)]] if done + len(group) < len(order) else 0
            held = given[possible]
            bound = (held >> bits) + coming * (dims - (held & ((1 << bits) - 1)))
            if len(possible) > k:
                fresh = [x for x in possible[np.argpartition(-bound, k - 1)[:k]].tolist() if x not in exact]
                exact |= zip(fresh, (self.vectors[fresh].astype(np.int64) @ query).tolist())
                reached = sorted(exact.values(), reverse=True)[k - 1]
                least = reached if least is None else max(least, reached)
                possible = possible[bound >= least]
            if stop * len(possible) <= self.n:
                break
        scores = self.vectors[possible].astype(np.int64) @ query
        best = np.lexsort((self.rows[possible], self.id_order[possible], -scores))[:k]
        return possible[best], scores[best], processed


def search_slice(index: DataFrame, queries: DataFrame, width: int, k: int) -> DataFrame:
    """The ``k`` best of every shard for each row of ``queries``, stored."""
    spark = index.sparkSession
    asked = queries.select("row", "vec_id", "v").toArrow()
    v = pa.concat_arrays(asked.column("v").chunks) if asked.num_rows else pa.array([], pa.list_(pa.int32()))
    shared = broadcast_object(spark, (asked.column("row").to_numpy(), asked.column("vec_id").to_pylist(), matrix_of(v, width)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_rows, query_ids, matrix = broadcast_value(shared)
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], width)
                out: list[list] = [[], [], [], [], []]
                for row, vec_id, query in zip(query_rows.tolist(), query_ids, matrix):
                    places, scores, _ = shard.search(query, row, k)
                    out[0] += [row] * len(places)
                    out[1] += [vec_id] * len(places)
                    out[2] += shard.rows[places].tolist()
                    out[3] += [shard.ids[p] for p in places.tolist()]
                    out[4] += scores.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["query_row", "query_id", "row", "vec_id", "score"])

    found = store(index.mapInArrow(work, FOUND), "found")
    shared.unpersist()
    return found
