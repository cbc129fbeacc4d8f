"""The line index under inserts and deletions: counts and filters equal those
of an index built at once, and a batch changes its own shards only."""
from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import tests_llm_plain as plain
from zonecast.llm import line_dedup


@pytest.fixture()
def small_shards(monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 8)
    monkeypatch.setattr(line_dedup, "TASK_ROWS", 16)


def texts(n, seed, common=120):
    rng = random.Random(seed)
    line = lambda: rng.choice(("short", "", f"a line that many documents share {rng.randrange(common)}", f"a line of its own {rng.random()}"))
    return ["\n".join(line() for _ in range(rng.randint(0, 12))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def shared_keys(index):
    return sorted(map(tuple, index.counts.select("hi", "lo", "refs", "first_doc", "last_doc").collect()))


def prints(index):
    """Per shard the multiset of (smaller bucket, fingerprint) as held."""
    out = {}
    for r in index.filters.collect():
        cuckoo = line_dedup.CuckooFilter.from_bytes(r["blob"])
        bucket, slot = np.nonzero(cuckoo.table)
        marks = cuckoo.table[bucket, slot]
        out[r["shard"]] = (len(cuckoo.table), sorted(zip(np.minimum(bucket, cuckoo._other(bucket, marks)).tolist(), marks.tolist())))
    return out


def assert_filters_hold_exactly(index):
    keys = {}
    for r in index.counts.select(line_dedup.shard_of(index.bits).alias("s"), "hi").collect():
        keys.setdefault(r["s"], []).append(r["hi"])
    held = prints(index)
    assert set(keys) <= set(held)
    for shard, (buckets, marks) in held.items():
        cuckoo = line_dedup.CuckooFilter(0)
        cuckoo.table = np.zeros((buckets, cuckoo.SLOTS), np.uint16)
        own = np.array(keys.get(shard, []), dtype=np.int64).view(np.uint64)
        first, mark = cuckoo._first(own), cuckoo._print(own)
        assert marks == sorted(zip(np.minimum(first, cuckoo._other(first, mark)).tolist(), mark.tolist())), shard


def test_batches_equal_one_build(spark, small_shards):
    rows = list(enumerate(texts(260, 1)))
    at_once = line_dedup.LineIndex().insert(frame(spark, rows[:240]))
    assert at_once.bits >= 3
    index = line_dedup.LineIndex().insert(frame(spark, rows[:150]))
    index = index.insert(frame(spark, rows[150:200])).insert(frame(spark, rows[200:]))
    assert_filters_hold_exactly(index)
    index = index.delete(frame(spark, rows[240:]))
    assert shared_keys(index) == shared_keys(at_once)
    assert_filters_hold_exactly(index)
    got = line_dedup.dedup_lines(frame(spark, rows[:240]), index).withColumn("sha", F.sha2("kept_text", 256))
    assert sorted(map(tuple, got.select("doc_id", "n_lines", "n_dropped", "sha").collect())) == plain.line_dedup(rows[:240])


def test_a_deletion_undoes_an_insertion(spark, small_shards):
    rows = list(enumerate(texts(150, 2)))
    index = line_dedup.LineIndex().insert(frame(spark, rows))
    more = index.insert(frame(spark, [(-1 - k, t) for k, (_, t) in enumerate(rows[:30])]))
    assert shared_keys(more) != shared_keys(index)
    back = more.delete(spark.createDataFrame([(-1 - k,) for k in range(30)], "doc_id long"))
    assert shared_keys(back) == shared_keys(index)
    assert_filters_hold_exactly(back)
    assert {s for s, (_, marks) in prints(index).items() if marks} == {s for s, (_, marks) in prints(back).items() if marks}


def test_a_batch_touches_its_shards_only(spark, small_shards):
    rows = list(enumerate(texts(200, 3)))
    index = line_dedup.LineIndex().insert(frame(spark, rows))
    before = prints(index)
    one = frame(spark, [(900, "a line of one batch that comes twice"), (901, "a line of one batch that comes twice")])
    after = prints(index.insert(one))
    lo = line_dedup.line_postings(one).select(line_dedup.shard_of(index.bits).alias("s")).distinct().collect()
    changed = {s for s in after if after[s] != before.get(s)}
    assert changed == {r["s"] for r in lo} and len(changed) == 1 and len(after) > 4
    shard = changed.pop()
    plan = index.postings.where(line_dedup.in_shards([shard], index.bits))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "OrEqual(lo," in plan
    for some in ([0], [shard], list(range(0, 1 << index.bits, 2)), list(range(1 << index.bits))):
        got = index.postings.where(line_dedup.in_shards(some, index.bits)).count()
        assert got == index.postings.where(line_dedup.shard_of(index.bits).isin(some)).count()


def test_filters_grow_with_their_shard(spark):
    rows = list(enumerate(texts(20, 4, common=9)))
    index = line_dedup.LineIndex().insert(frame(spark, rows))
    more = [(1000 + k, "\n".join(f"another line in two documents {k // 2} {j}" for j in range(40))) for k in range(60)]
    grown = index.insert(frame(spark, more))
    assert_filters_hold_exactly(grown)
    assert shared_keys(grown) == shared_keys(line_dedup.LineIndex().insert(frame(spark, rows + more)))


def test_null_and_shared_ids(spark, small_shards):
    some = texts(120, 5)
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, t) for k, t in enumerate(some)] + [(None, some[0]), (None, None), (None, "")]
    got = line_dedup.dedup_lines(frame(spark, rows)).withColumn("sha", F.sha2("kept_text", 256))
    last = 10**9
    want = sorted(plain.line_dedup([(last if d is None else d, t) for d, t in rows]))
    assert sorted((last if r[0] is None else r[0], *r[1:]) for r in got.select("doc_id", "n_lines", "n_dropped", "sha").collect()) == want
    drops = line_dedup.LineIndex().insert(frame(spark, rows)).drops()
    assert drops.where("size(keys) > 12").count() == 0  # no group spans texts of one id
    assert drops.select("doc", "row").distinct().count() == drops.count() > 30
