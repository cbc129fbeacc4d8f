"""Top-k search, periodic runs and phrase mining against brute force."""
from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import tests_llm_plain as plain
from zonecast.llm import impact_search, periodic_runs, phrase_mining, queries

VECTORS = "vec_id long, embedding array<float>, label int"


# ---- op11 --------------------------------------------------------------------
def plain_search(table, k=5, every=50):
    """``table``: (vec_id, embedding) rows; results in order of the queries."""
    ints = []
    for vec_id, e in table:
        if e is not None and all(x is not None and math.isfinite(x) for x in e):
            ints.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in e]))
    out = []
    for i, (q, v) in enumerate(ints):
        if q is not None and q % every == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), math.inf if c is None else c) for j, (c, w) in enumerate(ints) if j != i]
            out += [(q, r + 1, None if c == math.inf else c, -s) for r, (s, c) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select("query_id", "rank", "vec_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    table = [(i, [float(x) for x in rng.normal(0, 0.2, 12)]) for i in range(400)]
    same = table[7][1]
    table += [(i, same) for i in range(400, 460)] + [(50, same), (50, same), (None, same), (None, None), (500, None), (550, [0.1, None] * 6)]
    table += [(600, [float("nan")] + [0.0] * 11), (650, [float("-inf")] + [0.0] * 11), (700, []), (750, [1.0]), (800, [0.0] * 12), (801, [-3.5] * 12)]
    return table


@pytest.mark.parametrize("shard, stop", [(8192, 8), (50, 8), (50, 10**9), (3, 1)])
def test_search(spark, vectors, monkeypatch, shard, stop):
    monkeypatch.setattr(impact_search, "SHARD", shard)
    monkeypatch.setattr(impact_search.Shard.search, "__defaults__", (stop,))
    clash = [F.lit(1).alias(c) for c in ("row", "v", "score", "rank", "query_id", "n")]
    frame = spark.createDataFrame([(*r, 1) for r in vectors], VECTORS).select("*", *clash).repartition(3)
    assert found(impact_search.search_vectors(frame, F.col("vec_id") % 50 == 0)) == plain_search(vectors)


def test_search_of_few_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0], 0), (1, [-0.001, 0.0], 0), (50, [0.5, -1.0], None)], VECTORS)
    asked = F.col("vec_id") % 50 == 0
    assert found(impact_search.search_vectors(frame, asked)) == [(0, 1, 1, -256), (0, 2, 50, -98304), (50, 1, 1, -128), (50, 2, 0, -98304)]
    for nothing in (frame.limit(0), frame.where("vec_id = 1"), frame.where("vec_id = 0")):
        assert impact_search.search_vectors(nothing, asked).count() == 0
    # a component whose scores pass 64 bits takes no part
    huge = frame.union(spark.createDataFrame([(100, [3e38, 0.0], 0)], VECTORS))
    assert {r[0] for r in found(impact_search.search_vectors(huge, asked))} == {0, 50}


def test_search_in_slices_of_queries(spark, vectors, monkeypatch):
    monkeypatch.setattr(impact_search, "QUERY_BYTES", 200)
    frame = spark.createDataFrame([(*r, 1) for r in vectors], VECTORS)
    assert found(impact_search.search_vectors(frame, F.col("vec_id") % 50 == 0)) == plain_search(vectors)


def test_search_stops_on_proof_before_the_last_posting():
    rng = np.random.default_rng(6)
    v = rng.normal(0, 3, (4000, 16)).round().astype(np.int32)
    v[:, 4:] //= 6
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(4000)), pa.array(np.arange(4000)), pa.array(list(v), pa.list_(pa.int32()))], ["row", "vec_id", "v"])
    shard = impact_search.Shard(impact_search.shard_of([batch], 16).to_pylist()[0], 16)
    for q in range(20):
        places, scores, processed = shard.search(v[q], q, 5)
        want = np.lexsort((np.arange(4000), -(v.astype(np.int64) @ v[q])))
        want = want[want != q][:5]
        assert places.tolist() == want.tolist() and processed < 16 * 4000
        assert scores.tolist() == (v[want].astype(np.int64) @ v[q]).tolist()


# ---- op12 --------------------------------------------------------------------
def plain_runs(words, min_length=6, min_exponent=4):
    """(start, length, period): islands of equal words at each distance."""
    n, least = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_exponent * q):
                least.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((a, n, q) for (a, n), q in least.items())


def plain_tail(doc, words):
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def plain_periodic(doc, text):
    words = plain_tail(doc, plain.words(text))
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc, len(runs), s, n, q, None if n is None else 1000 * n // q, sha("".join(f"{a},{b},{c}\n" for a, b, c in sorted(runs, key=lambda r: (r[0], r[2])))),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def repeating_texts(n=120):
    rng = np.random.default_rng(8)
    texts = []
    for _ in range(n):
        words: list[str] = []
        for _ in range(int(rng.integers(1, 8))):
            stretch = [f"w{x}" for x in rng.integers(0, rng.choice([2, 6, 50]), int(rng.integers(1, 7)))]
            words += stretch * int(rng.integers(1, 9))
        texts.append("\n ".join(words))
    return texts


ODD = [None, "", " \t\n ", "one", "x y " * 40, "a a a a a", "a a a a a a", "ab ab ab ab", "a b a b a b a b", "Word, " * 3000, "é é é é é é ß"]


@pytest.fixture(scope="module")
def repeats():
    texts = repeating_texts() + ODD
    return [*enumerate(texts), (None, "u " * 9), (5, "v " * 9), (5, "v " * 9)]


def test_periodic_runs_query(spark, repeats, monkeypatch):
    rows = [(d, t, "clash", 1) for d, t in repeats]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int").repartition(3)
    monkeypatch.setattr(queries, "_table", lambda *_: frame)
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, "").collect()]
    want = [plain_periodic(d, t) for d, t in repeats]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(w[1] for w in want) > 100
    monkeypatch.setattr(queries, "_table", lambda *_: frame.limit(0))
    assert queries.op12_periodic_runs(spark, "").count() == 0


@pytest.mark.parametrize("min_length, min_exponent", [(6, 4), (2, 2), (6, 2), (3, 3), (10, 2), (1000, 5)])
def test_runs_of_any_threshold(min_length, min_exponent):
    texts = [plain.words(t) for t in repeating_texts()]
    codes = {w: i for i, w in enumerate({w for t in texts for w in t})}
    starts = np.cumsum([0, *map(len, texts)])
    symbols = np.array([codes[w] for t in texts for w in t], dtype=np.uint64)
    got = list(zip(*(x.tolist() for x in periodic_runs.find_runs(symbols, starts, min_length, min_exponent))))
    want = [(a + int(s), n, q) for s, t in zip(starts, texts) for a, n, q in sorted(plain_runs(t, min_length, min_exponent), key=lambda r: (r[0], r[2]))]
    assert got == want


def test_suffix_ranks_and_common_prefixes():
    rng = np.random.default_rng(3)
    symbols, edges = rng.integers(0, 2, 300), np.array([0, 0, 120, 121, 300])
    levels, open_ = periodic_runs.rank_prefixes(symbols, edges)
    suffixes = [(t, symbols[i:b].tolist()) for t, (a, b) in enumerate(zip(edges, edges[1:])) for i in range(a, b)]
    order = sorted(range(300), key=lambda i: suffixes[i])
    assert not len(open_) and [order.index(i) for i in range(300)] == levels[-1].tolist()
    common = lambda x, y: 0 if x[0] != y[0] else next((k for k in range(min(len(x[1]), len(y[1]))) if x[1][k] != y[1][k]), min(len(x[1]), len(y[1])))
    want = [0] + [common(suffixes[a], suffixes[b]) for a, b in zip(order, order[1:])]
    assert periodic_runs.common_prefixes(levels[:-1], np.array(order)).tolist() == want


def test_threshold_below_two_is_an_error(docs):
    with pytest.raises(ValueError):
        periodic_runs.collapse_runs(docs, min_exponent=1)


# ---- op13 --------------------------------------------------------------------
def plain_mining(docs, min_count=10, max_words=3, keep=2000, covered=50):
    counts, totals = collections.Counter(), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", plain.low(text)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                counts.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    phrases = {key: a for key, a in counts.items() if a >= min_count and len(key[1]) > 1}
    inside: dict = {}
    for (lang, words), a in phrases.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inner = (lang, words[i:i + k])
                inside[inner] = max(a, inside.get(inner, 0))
    out = []
    for lang in totals:
        rows = []
        for (other, words), a in phrases.items():
            if other == lang and not 100 * inside.get((lang, words), 0) >= covered * a:
                cuts = [(10**6 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:keep])]
    return sorted(out)


def mined(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def phrases():
    rng = np.random.default_rng(9)
    weights = 1 / np.arange(1, 61)
    out = []
    for i in range(150):
        words = [f"W{x}" for x in rng.choice(60, int(rng.integers(0, 200)), p=weights / weights.sum())]
        for _ in range(3):
            words[len(words) // 2:len(words) // 2] = ["New", "York", "City"]
        text = "".join(w + str(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\x0b", " ! "])) for w in words)
        out.append((["en", "fr", None, "und", ""][i % 5], text))
    return out + [("en", None), (None, ""), ("fr", "é é é, " * 40), ("x y", "a " * 3000), ("de", " .,\n "), ("en", "the the\x00 the\x1c " * 20)]


@pytest.fixture(scope="module")
def phrase_docs(spark, phrases):
    rows = [(i % 7 or None, t, lang) for i, (lang, t) in enumerate(phrases)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    return frame.select("*", *[F.lit("clash").alias(c) for c in ("phrase", "n", "seg", "words", "codes", "id", "slice", "k")])


@pytest.mark.parametrize("options", [{}, {"min_count": 3, "max_words": 4, "keep": 50}, {"min_count": 30, "max_words": 2, "covered": 90}])
def test_phrases(phrase_docs, phrases, options):
    got, want = mined(phrase_mining.mine_phrases(phrase_docs, **options)), plain_mining(phrases, **options)
    assert got == want and len(want) > 30


def test_phrases_in_slices_and_full_bit_sets(phrase_docs, phrases, monkeypatch):
    monkeypatch.setattr(phrase_mining, "TRIE_PHRASES", 100)
    monkeypatch.setattr(phrase_mining, "has_bits", lambda bits, hashes: np.ones(len(hashes), dtype=bool))
    assert mined(phrase_mining.mine_phrases(phrase_docs)) == plain_mining(phrases)


def test_phrases_of_nothing(phrase_docs):
    assert phrase_mining.mine_phrases(phrase_docs.limit(0)).count() == 0
    assert phrase_mining.mine_phrases(phrase_docs.where("lang = 'de'")).count() == 0
    with pytest.raises(ValueError):
        phrase_mining.mine_phrases(phrase_docs, max_words=1)


def test_scores_beyond_64_bits(spark):
    counts = [("en", "a b", 4 * 10**9), ("en", "a", 5 * 10**9), ("en", "b", 7 * 10**9), ("en", "b c", 12), ("en", "c", 12), ("en", "a b c", 12)]
    segments = spark.createDataFrame([("en", 10**11)], "lang string, n long")
    got = phrase_mining.rank_phrases(segments, spark.createDataFrame(counts, "lang string, phrase string, f long"), 10, 50)
    big = 10**6 * 16 * 10**18 // (35 * 10**18)
    assert mined(got) == [("en", 1, "a b", 4 * 10**9, 5 * 10**9, 7 * 10**9, 10**11, big), ("en", 2, "a b c", 12, 5 * 10**9, 12, 10**11, 0)]


def test_trie_counts_what_occurs(phrases):
    langs, texts = ["und" if x is None else x for x, _ in phrases], [t or "" for _, t in phrases]
    batch = phrase_mining.segments_of(pa.array(langs), pa.array(texts))
    want = collections.Counter()
    for lang, text in zip(langs, texts):
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", plain.low(text)):
            words = re.findall("[^ \t]+", piece)
            want.update((lang, " ".join(words[i:i + k])) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    asked = [*sorted(want)[::2], ("en", "w1 w1 w1 nowhere"), ("nowhere", "w1")]
    trie = phrase_mining.DoubleArrayTrie(pa.array([x for x, _ in asked]), pa.array([p for _, p in asked]))
    trie = phrase_mining.DoubleArrayTrie.from_bytes(trie.to_bytes())
    got = sum(np.bincount(trie.matches(phrase_mining.Segment(batch, i), 4), minlength=len(asked)) for i in range(batch.num_rows))
    assert got.tolist() == [want[x] for x in asked]


def test_phrases_across_the_blocks_of_a_segment(phrase_docs, phrases, monkeypatch):
    """Phrases that begin in one block of positions and end in the next."""
    monkeypatch.setattr(phrase_mining, "BLOCK", 5)
    batch = phrase_mining.segments_of(pa.array(["en"]), pa.array(["a b c, a b c d. " * 9]))
    segment, every = phrase_mining.Segment(batch, 0), np.full(1 << (phrase_mining.BITS - 3), 255, np.uint8)
    for k, n in ((1, 63), (2, 45), (3, 27), (4, 9)):
        at, hashes = phrase_mining.phrase_hashes(segment, k, [every] * (k - 1))
        assert len(at) == n and at.tolist() == sorted(set(at.tolist()))
        assert len(set(hashes.tolist())) == {1: 4, 2: 3, 3: 2, 4: 1}[k]
    trie = phrase_mining.DoubleArrayTrie(pa.array(["en"] * 4), pa.array(["a b", "b c d", "a b c d", "d"]))
    assert np.bincount(trie.matches(segment, 4), minlength=4).tolist() == [18, 9, 9, 9]


def test_trie_of_a_broadcast_is_not_copied():
    data = phrase_mining.DoubleArrayTrie(pa.array(["en", "fr"]), pa.array(["a b", "c"])).to_bytes()
    trie, held = phrase_mining.DoubleArrayTrie.from_bytes(data), np.frombuffer(data, np.uint8)
    assert all(np.shares_memory(x, held) for x in (trie.base, trie.check, trie.accept, trie.table.keys))


def test_segments_reach_workers_a_few_at_a_time(phrase_docs, phrases, monkeypatch):
    """Large rows would pile up in buffers; the session's setting comes back."""
    spark, name, rows = phrase_docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", {}
    before, plain_store = spark.conf.get(name), phrase_mining.store
    monkeypatch.setattr(phrase_mining, "store", lambda frame, at: (rows.setdefault(at, int(spark.conf.get(name))), plain_store(frame, at))[1])
    assert mined(phrase_mining.mine_phrases(phrase_docs)) == plain_mining(phrases)
    assert all(rows[x] == phrase_mining.SEGMENT_ROWS for x in ("frequent-1", "frequent-2", "frequent-3", "candidates", "trie-counts"))
    assert rows["segments"] == phrase_mining.TEXT_ROWS and spark.conf.get(name) == before


def test_batches_are_put_together():
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(["ab", None, ""])}) for _ in range(7)]
    got = list(phrase_mining.gathered(iter(batches), limit=5))
    assert [b.num_rows for b in got] == [6, 6, 6, 3] and not list(phrase_mining.gathered(iter([])))
