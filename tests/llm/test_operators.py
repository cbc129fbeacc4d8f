"""Every operator against its brute-force version, on odd rows and on none."""
from __future__ import annotations

import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import tests_llm_plain as plain
from zonecast.llm import (
    fm_dedup, html_blocks, line_dedup, phrase_index, quality_ngrams, queries, simhash_pivots, simple8b, source_mix, suffix_tree_lm,
)
from zonecast.llm.components import connected_components


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=lambda r: (r[0] is None, r[0], r[1:]))


# ---- op1 ---------------------------------------------------------------------
PAGE = (
    "<html><head><title>T &amp; t</title><style>p{}</style><script>var a='</p>';</script></head><body><nav><a href=/>Home</a></nav>"
    "<!-- <p>no</p> --><div class='ad'>Buy it now</div><article><h1>Big &lt;news&gt;</h1><p>First\n  line &amp; more<br>here.</p>"
    "<p>Ok.</p><p><b>Bold <p>next one</article><form><p>Name</p></form><section id=comments><p>I think so too</p></section><footer>&copy; us</footer>"
)


def test_html_blocks(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, 0), (2, None, None, 0), (3, "u", "", 0), (4, "u", "<p>unclosed <b", 0), (4, "u", PAGE, 0), (None, "u", "<!-- x", 0)],
        "page_id long, url string, html string, n_chars int",
    )
    got = rows(html_blocks.extract_pages(pages), "page_id", "text", "n_chars")
    text = "Big <news>\nFirst line & more here.\nOk.\nBold\nnext one"
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, text, len(text)), (2, "", 0), (3, "", 0)]
    assert (4, text, len(text)) in got and got[-1] == (None, "", 0)
    assert html_blocks.extract_pages(pages.limit(0)).count() == 0


def test_html_tree_fits_its_table():
    x, y = html_blocks.labelled_table()
    assert (html_blocks.classify(html_blocks.train_tree(), x) == y).mean() > 0.95


# ---- op2 ---------------------------------------------------------------------
def test_line_dedup(docs, pairs, nothing):
    got = line_dedup.dedup_lines(docs).withColumn("sha", F.sha2("kept_text", 256))
    assert rows(got, "doc_id", "n_lines", "n_dropped", "sha") == plain.line_dedup(pairs)
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_line_dedup_is_reversible(docs, pairs):
    index = line_dedup.LineIndex().insert(docs)
    before = rows(index.drops().select("doc", F.array_sort("keys").alias("k")), "doc", "k")
    extra = docs.select((F.col("doc_id") - 1000).alias("doc_id"), "text")  # earlier ids take over every key
    more = index.insert(extra)
    assert rows(more.drops(), "doc") != [(r[0],) for r in before]
    back = more.delete(extra.select("doc_id"))
    assert rows(back.drops().select("doc", F.array_sort("keys").alias("k")), "doc", "k") == before
    left = [p for p in pairs if p[0] % 2]
    odd = docs.where("doc_id % 2 = 1")
    got = line_dedup.dedup_lines(odd, index.delete(docs.where("doc_id % 2 = 0").select("doc_id"))).withColumn("sha", F.sha2("kept_text", 256))
    assert rows(got, "doc_id", "n_lines", "n_dropped", "sha") == plain.line_dedup(left)


def test_cuckoo_filter():
    keys = np.random.default_rng(0).integers(0, 2**64, 50_000, dtype=np.uint64)
    cuckoo = line_dedup.CuckooFilter.of(keys[:40_000])
    assert cuckoo.contains(keys[:40_000]).all()
    assert cuckoo.contains(keys[40_000:]).mean() < 0.01
    cuckoo.delete(keys[:300])
    assert cuckoo.contains(keys[300:40_000]).all() and cuckoo.contains(keys[:300]).mean() < 0.05
    again = line_dedup.CuckooFilter.from_bytes(cuckoo.to_bytes())
    assert again.insert(keys[:300]) and again.contains(keys[:40_000]).all()


# ---- op3 ---------------------------------------------------------------------
def test_suffix_tree_base(docs, pairs, nothing):
    got = rows(suffix_tree_lm.score_documents(docs, max_words=2), "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    want = plain.unigram(pairs)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])
    assert suffix_tree_lm.score_documents(nothing, max_words=2).count() == 0


def test_shuffles_of_a_stored_table_are_gone_once_it_is_written(spark, docs):
    """They would lie on the executors' disks until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = lambda: set(re.findall(r"shuffle_\d+", spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")))
    before, found = spark.conf.get(name), held()
    counts = suffix_tree_lm.word_counts(docs)
    end = time.time() + 20
    while held() - found and time.time() < end:
        time.sleep(0.2)
    assert not held() - found and counts.count() and spark.conf.get(name) == before



def chained_texts(n=400):
    rng = np.random.default_rng(1)
    follows = {"a": "b", "b": "c", "c": "a"}
    texts = []
    for _ in range(n):
        w = ["a"]
        for _ in range(40):
            w.append(follows[w[-1]] if rng.random() < 0.9 else "abc"[rng.integers(3)])
        texts.append(" ".join(w))
    return texts


def test_suffix_tree_learns_and_sums_to_one(spark):
    docs = spark.createDataFrame(list(enumerate(chained_texts())), "doc_id long, text string")
    counts = suffix_tree_lm.word_counts(docs)
    heavy = suffix_tree_lm.heavy_words(counts)
    corpus = suffix_tree_lm.encode_corpus(docs, heavy)
    tree = suffix_tree_lm.grow_tree(corpus, heavy, max_words=2)
    assert not np.isnan(tree.word_rest).all()
    r = suffix_tree_lm.score_corpus(corpus, counts, tree).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > 0.7 * r[1]  # negative: the tree explains far more
    # the distribution after "a b": all named symbols and the unseen one; the chain
    # looks one word back, so only without a penalty are there longer states
    tree = suffix_tree_lm.grow_tree(corpus, heavy, penalty=0.0)
    assert tree.triples.count()
    ranks = {w: int(heavy.rank_of(plain_hash(w))[0]) for w in "abc"} | {"end": heavy.end, "new": -1}
    pairs, triples = tree.pairs.orderBy("key").toPandas(), tree.triples.orderBy("key").toPandas()
    base = 10 ** heavy.log_base()
    total = 0.0
    for w, k in ranks.items():
        t = suffix_tree_lm.Tokens([3], suffix_tree_lm.byte_planes(np.array([ranks["a"], ranks["b"], k])), [False])
        ratio = 10 ** suffix_tree_lm.log_ratios(
            t, heavy, tree.word_rest, tuple(pairs[c].to_numpy() for c in ("key", "n", "rest")), tuple(triples[c].to_numpy() for c in ("key", "n"))
        )[2]
        total += ratio * (base[k] if k >= 0 else 1 / (heavy.tokens + heavy.distinct + 1))
    assert abs(total - 1) < 1e-9


@pytest.mark.parametrize("penalty", [0.0, 0.2, 1.0])
def test_suffix_tree_scores(spark, docs, pairs, penalty):
    options = {"min_context": 5, "min_symbol": 2, "penalty": penalty, "max_words": 2}
    cases = [(docs, pairs), (spark.createDataFrame(rows3 := list(enumerate(chained_texts(60))), "doc_id long, text string").repartition(4), rows3)]
    for frame, texts in cases:
        got = rows(suffix_tree_lm.score_documents(frame, **options), "doc_id", "score")
        assert np.allclose([g[1] for g in got], [s for _, s in plain.suffix_tree(texts, **options)])


def test_suffix_tree_of_small_segments_and_full_bit_sets(spark, docs, pairs, monkeypatch):
    options = {"min_context": 5, "min_symbol": 2, "penalty": 0.1, "max_words": 2}
    want = [s for _, s in plain.suffix_tree(pairs, **options)]
    counts = suffix_tree_lm.word_counts(docs)
    heavy = suffix_tree_lm.heavy_words(counts)
    corpus = suffix_tree_lm.encode_corpus(docs, heavy, segment_tokens=50)
    monkeypatch.setattr(suffix_tree_lm, "may_hold", lambda bits, keys: np.ones(len(keys), dtype=bool))
    got = rows(suffix_tree_lm.score_corpus(corpus, counts, suffix_tree_lm.grow_tree(corpus, heavy, **options)), "doc_id", "score")
    assert np.allclose([g[1] for g in got], want)


def test_suffix_tree_grows_with_the_corpus(spark):
    def size(n):
        texts = [" ".join(f"w{i}{x}" for x in "ab") + " " + " ".join(f"w{i}{x}" for x in "abc") for i in range(n) for _ in range(40)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        heavy = suffix_tree_lm.heavy_words(suffix_tree_lm.word_counts(docs))
        return suffix_tree_lm.grow_tree(suffix_tree_lm.encode_corpus(docs, heavy), heavy, max_words=2).pairs.count()

    assert size(40) >= 3.5 * size(10) > 0


def test_suffix_tree_does_not_depend_on_the_share_of_a_word(spark, docs, pairs, monkeypatch):
    """Words below ``HEAVY`` of all tokens are contexts and symbols like any other."""
    options = {"min_context": 5, "min_symbol": 2, "penalty": 0.1, "max_words": 2}
    phrase = [(1000 + i, "foo bar baz qux") for i in range(60)]
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(phrase, "doc_id long, text string"))
    want = [s for _, s in plain.suffix_tree(pairs + phrase, **options)]
    for share in (0.01, 0.2, 2.0):
        monkeypatch.setattr(suffix_tree_lm.heavy_words, "__defaults__", (share,))
        got = rows(suffix_tree_lm.score_documents(frame, **options), "doc_id", "score")
        assert np.allclose([g[1] for g in got], want)


def test_suffix_tree_has_contexts_of_more_than_two_words(spark):
    """What follows "b c d" is told by the word before: a context of four, and
    there is no state of two words or of three on the way to it."""
    texts = [f"{x} b c d {x}{x}" for x in "ae" for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    two, grown = (
        {r["doc_id"]: r["score"] for r in suffix_tree_lm.score_documents(docs, max_words=n).collect()} for n in (2, None)
    )
    # the end after "d xx" and the words before are as before; the last word is sure
    assert all(grown[i] > two[i] + 0.25 for i in two)
    counts = suffix_tree_lm.word_counts(docs)
    heavy = suffix_tree_lm.heavy_words(counts)
    tree = suffix_tree_lm.grow_tree(suffix_tree_lm.encode_corpus(docs, heavy), heavy, max_words=None)
    assert len(tree.levels) > 2


def test_suffix_tree_of_any_length(spark):
    """No bound on the contexts, against all contexts of up to eight words."""
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(6)]
    texts = [" ".join([*rng.choice(words, 3), *(["a b c d e"] if i % 2 else ["z b c d f"]), *rng.choice(words, 2)]) for i in range(60)]
    pairs = list(enumerate(texts))
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    options = {"min_context": 6, "min_symbol": 3, "penalty": 0.3}
    got = rows(suffix_tree_lm.score_documents(docs, **options), "doc_id", "score")
    assert np.allclose([g[1] for g in got], [s for _, s in plain.suffix_tree(pairs, **options, max_words=8)])
    assert not np.allclose([g[1] for g in got], [s for _, s in plain.suffix_tree(pairs, **options, max_words=2)])


def test_suffix_tree_context_that_also_starts_texts(spark):
    """"q" stands before "a b" wherever a word does, but half of its occurrences start a text."""
    pairs = list(enumerate(["q a b c", "a b d"] * 40))
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    options = {"min_context": 16, "min_symbol": 4, "penalty": 0.5}
    got = rows(suffix_tree_lm.score_documents(docs, **options), "doc_id", "score")
    assert np.allclose([g[1] for g in got], [s for _, s in plain.suffix_tree(pairs, **options, max_words=4)])


def test_bit_set_of_few_keys_lets_few_others_through(spark):
    """What it lets through is dealt with all its words."""
    keys = np.random.default_rng(5).integers(-2**63, 2**63, 101_000)
    bits = suffix_tree_lm.bit_set(spark.createDataFrame([(int(k),) for k in keys[:1000]], "key long"))
    assert suffix_tree_lm.may_hold(bits, keys[:1000]).all()
    assert suffix_tree_lm.may_hold(bits, keys[1000:]).mean() < 0.002
    assert not suffix_tree_lm.bit_set(spark.createDataFrame([], "key long")).any()


def test_positions_of_one_passage_are_dealt_in_few_bytes(spark):
    passage = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(i, f"{passage} z{i % 2}") for i in range(400)], "doc_id long, text string").coalesce(1)
    heavy = suffix_tree_lm.heavy_words(suffix_tree_lm.word_counts(docs))
    corpus = suffix_tree_lm.encode_corpus(docs, heavy)
    t = suffix_tree_lm.unpacked(corpus.first().asDict())
    on = np.flatnonzero(t.train & (t.offset > 2)) - 1
    keys = spark.createDataFrame([(int(k),) for k in set(suffix_tree_lm.runs(t.codes(heavy), 2)[on].tolist())], "key long")
    shared, gates = suffix_tree_lm.broadcast_object(spark, heavy), suffix_tree_lm.share_sets(spark, (suffix_tree_lm.bit_set(keys), None))
    dealt = suffix_tree_lm.deal_positions(corpus, shared, gates, 2, 35, 1, 32).collect()
    assert sum(suffix_tree_lm.unpack(r["times"]).sum() for r in dealt) == len(on)
    assert sum(len(r["words"]) for r in dealt) < len(on) * 33 * 4 / 20


def test_suffix_tree_dealt_in_many_buckets_and_rounds(spark, monkeypatch):
    """Contexts split further before dealing, several buckets, and contexts that
    are open where the words dealt end: the scores stay those of the brute force."""
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(5)]
    texts = [" ".join([*rng.choice(words, 3), ("a" if i % 2 else "z") + f" b c d e g h {i % 2}", *rng.choice(words, 2)]) for i in range(90)]
    pairs = list(enumerate(texts))
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(3)
    options = {"min_context": 6, "min_symbol": 3, "penalty": 0.3}
    want = [s for _, s in plain.suffix_tree(pairs, **options, max_words=9)]
    for dealt, bucket, history, share in ((1 << 19, 1 << 10, 1, 0.0), (40, 1 << 12, 2, 0.0), (40, 1 << 23, 1, 0.02)):
        monkeypatch.setattr(suffix_tree_lm, "DEALT", dealt)
        monkeypatch.setattr(suffix_tree_lm, "BUCKET_WORDS", bucket)
        monkeypatch.setattr(suffix_tree_lm, "HISTORY", history)
        monkeypatch.setattr(suffix_tree_lm.heavy_words, "__defaults__", (share,))
        got = rows(suffix_tree_lm.score_documents(docs, **options), "doc_id", "score")
        assert np.allclose([g[1] for g in got], want)


def plain_hash(word):
    from zonecast.llm.common import hashes_of

    return hashes_of([word.encode()])


# ---- op4 ---------------------------------------------------------------------
DIGEST = ("doc_id", "n_words", "n_hit", "n_items", "sha", "dirty")


def digest(found):
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").alias("n_items"), phrase_index.items_digest("item_ids").alias("sha"), (F.col("n_hit") > 0).alias("dirty")
    )


@pytest.mark.parametrize("query_bytes", [phrase_index.QUERY_BYTES, 200])
def test_decontamination(docs, pairs, benchmark, query_bytes):
    items = [("" if r[0] is None else r[0], r[1]) for r in benchmark.collect()]
    got = rows(digest(phrase_index.decontaminate(docs, benchmark, query_bytes=query_bytes)), *DIGEST)
    want = plain.decontaminate(pairs, items)
    assert got == want and any(w[5] for w in want) and not all(w[5] for w in want)


def test_decontamination_of_nothing(docs, benchmark, nothing):
    assert phrase_index.decontaminate(nothing, benchmark).count() == 0
    assert phrase_index.decontaminate(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0
    clean = phrase_index.keep_clean(docs, benchmark)
    assert clean.columns == docs.columns and 0 < clean.count() < docs.count()


def test_proximity_and_small_segments(spark):
    docs = spark.createDataFrame([(1, "red fox runs"), (2, "red quick fox runs"), (3, "fox"), (4, "red")], "doc_id long, text string").coalesce(1)
    index = phrase_index.build_index(docs, segment_words=1)
    find = lambda slop: rows(phrase_index.search_index(index, [("q", b"red fox")], window=None, slop=slop).where("size(item_ids) > 0"), "doc_id", "item_ids")
    assert [r[0] for r in find(0)] == [1] and [r[0] for r in find(1)] == [1, 2]


# ---- op5 ---------------------------------------------------------------------
def test_source_mix(docs, pairs, nothing):
    got = source_mix.mix_sizes(docs).toPandas()
    again = source_mix.mix_sizes(docs.repartition(7)).toPandas()
    order = ["doc_id", "size", "source_size", "target", "taken"]
    assert got.sort_values("doc_id")[order].reset_index(drop=True).equals(again.sort_values("doc_id")[order].reset_index(drop=True))
    sizes = {i: len(plain.words(t)) for i, t in pairs}
    assert dict(zip(got.doc_id, got["size"])) == sizes
    got["src"] = got.source.where(got.source.notna(), None)
    want = plain.targets([(None if i % 11 == 0 else f"s{i % 5}", n) for i, n in sizes.items()])
    for source, target in want.items():
        mine = got[got.source.isna()] if source is None else got[got.source == source]
        assert abs(mine.target - target).max() < 1e-6 and abs(mine.taken.sum() - target) <= 0.5 + 1e-6
    assert (got.taken <= 3 * got["size"]).all() and (got.taken >= 0).all()
    assert source_mix.mix_sizes(nothing).count() == 0 and source_mix.mix_documents(nothing).count() == 0


def test_mixed_documents_are_whole(docs, texts):
    mixed = source_mix.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert all(r["text"] == texts[r["doc_id"]] for r in mixed.collect())
    plan = mixed._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_capped_sources(spark):
    docs = spark.createDataFrame([(1, "a " * 900, "a"), (2, "b", "b"), (3, "c c", "c"), (3, "c c", "c"), (4, None, "d")], "doc_id long, text string, source string")
    got = {r["source"]: r["target"] for r in source_mix.mix_sizes(docs).collect()}
    want = plain.targets([("a", 900), ("b", 1), ("c", 4), ("d", 0)])
    assert got == pytest.approx(want) and got["b"] == 3


# ---- op6 ---------------------------------------------------------------------
def test_simhash(docs, pairs, nothing):
    fps = {i: plain.simhash(t) for i, t in pairs}
    got = rows(simhash_pivots.simhash_components(docs), "doc_id", "fp", "component_id")
    label = plain.components(fps)
    assert got == [(i, int(np.uint64(fps[i]).view(np.int64)), label[i]) for i in sorted(fps)]
    assert len(set(label.values())) < len(label)
    assert simhash_pivots.simhash_components(nothing).count() == 0
    kept = simhash_pivots.keep_one_per_component(docs.unionByName(docs))
    assert kept.columns == docs.columns and rows(kept, "doc_id") == [(i,) for i in sorted(set(label.values()))]


def test_near_copies_of_null_ids(spark):
    """Null-id rows link nothing but what resembles their own text."""
    x, y, z, u = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyzu")
    table = [(1, x), (2, y), (None, x), (None, y), (None, z), (None, z), (None, u)]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    got = simhash_pivots.simhash_components(docs).collect()
    assert sorted((r["doc_id"] or 9, r["component_id"] or 9) for r in got) == [(1, 1), (2, 2), (9, 1), (9, 2), (9, 9), (9, 9), (9, 9)]
    kept = simhash_pivots.keep_one_per_component(docs)
    assert sorted((r["doc_id"] or 9, r["text"]) for r in kept.collect()) == sorted([(1, x), (2, y), (9, z), (9, u)])
    # of rows with one id the text of the smallest fingerprint stays
    pair = spark.createDataFrame([(5, x), (5, z), (6, z)], "doc_id long, text string")
    want = min((x, z), key=lambda t: np.uint64(plain.simhash(t)).view(np.int64))
    assert [tuple(r) for r in simhash_pivots.keep_one_per_component(pair).collect()] == [(5, want)]


def test_clean_rows_of_null_ids_stay(spark):
    words = " ".join(f"w{i}" for i in range(12))
    items = spark.createDataFrame([(1, words)], "item_id long, text string")
    table = [(None, f"some {words} here"), (None, "quite clean"), (None, None), (3, "clean"), (4, words)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    kept = phrase_index.keep_clean(docs, items).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == [(0, ""), (0, "quite clean"), (3, "clean")]


def test_links_within_three_bits(spark):
    rng = np.random.default_rng(5)
    fps = {}
    for k in range(60):
        base = int(rng.integers(0, 2**64, dtype=np.uint64))
        for j in range(8):
            fps[8 * k + j] = base
            base ^= sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 6)), replace=False))
    frame = spark.createDataFrame([(int(np.uint64(f).view(np.int64)), i) for f, i in {f: i for i, f in reversed(fps.items())}.items()], "fp long, node long")
    links = simhash_pivots.fingerprint_links(frame, max_bits=3)
    found = {r["node"]: r["component"] for r in connected_components(links).collect()}
    nodes = {r["node"]: int(np.int64(r["fp"]).view(np.uint64)) for r in frame.collect()}
    assert {i: found.get(i, i) for i in nodes} == plain.components(nodes)


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(3, 3)]
    frame = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["component"] for r in connected_components(frame).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {k: 7 for k in [7, *range(200, 260)]}
    assert connected_components(frame.limit(0)).count() == 0


# ---- op8 ---------------------------------------------------------------------
def test_quality_measures(docs, pairs, nothing):
    model = quality_ngrams.QualityModel(None, 0.0, 1.0, 0.0)
    got = rows(quality_ngrams.score_quality(docs, model), "doc_id", *quality_ngrams.MEASURES, "base_failed", "kept")
    for g, (i, t) in zip(got, pairs):
        n, chars, symbols, dup, rep = plain.measures(t)
        failed = n < 20 or 100 * rep > 30 * n
        assert g == (i, n, chars, symbols, dup, rep, failed, not failed)
    assert quality_ngrams.score_quality(nothing, model).count() == 0
    kept = quality_ngrams.keep_good(docs, model)
    assert kept.columns == docs.columns and rows(kept, "doc_id") == [(g[0],) for g in got if g[-1]]


def test_quality_held_out_accuracy(spark):
    rng = np.random.default_rng(2)
    good, bad = [f"word{i}" for i in range(80)], [f"BUY{i}!!" for i in range(40)] + [f"word{i}" for i in range(40)]
    data = [(i, " ".join(rng.choice(bad if i % 3 == 0 else good, 60)), int(i % 3 != 0)) for i in range(300)]
    docs = spark.createDataFrame([d[:2] for d in data], "doc_id long, text string")
    labels = spark.createDataFrame([(d[0], d[2]) for d in data[:200]] + [(None, 1), (5, None), (9999, 0), (1, 1)], "doc_id long, quality int")
    model = quality_ngrams.train_quality(docs, labels)
    out = {r["doc_id"]: r for r in quality_ngrams.score_quality(docs, model).collect()}
    assert np.mean([(out[i]["probability"] >= 0.5) == bool(q) for i, _, q in data[200:]]) >= 0.97
    again = quality_ngrams.train_quality(docs.repartition(5), labels)
    assert np.allclose(model.weights, again.weights, atol=1e-3)
    assert quality_ngrams.train_quality(docs, labels.limit(0)).weights is None


def test_quality_of_few_labels_and_several_texts(spark):
    """Five labels of each class always give a model, and the same one whatever
    the order of the rows of a repeated id."""
    rng = np.random.default_rng(12)
    for seed in range(6):
        ids = rng.choice(10**6, 10, replace=False).tolist()
        rows = [(int(d), ("good words here " if i % 2 else "BAD!! TEXT$$ ") * 10) for i, d in enumerate(ids)]
        rows += [(int(ids[0]), "another text"), (int(ids[0]), "a third text")]
        labels = spark.createDataFrame([(int(d), i % 2) for i, d in enumerate(ids)], "doc_id long, quality int")
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        sample = quality_ngrams.labelled_sample(docs, labels)
        assert sorted(tuple(r) for r in sample.collect()) == sorted(tuple(r) for r in quality_ngrams.labelled_sample(docs.orderBy("text"), labels).collect())
        held = [(r["label"], r["held"]) for r in sample.collect()]
        assert all(held.count((c, True)) == 1 and held.count((c, False)) == 4 for c in (0.0, 1.0))
        if seed == 0:
            model = quality_ngrams.train_quality(docs, labels)
            assert model.weights is not None
            assert quality_ngrams.train_quality(docs, labels.limit(9)).weights is None


# ---- op9 ---------------------------------------------------------------------
@pytest.mark.parametrize("hot", [fm_dedup.HOT, 0])
def test_substring_dedup(docs, pairs, nothing, monkeypatch, hot):
    monkeypatch.setattr(fm_dedup, "HOT", hot)
    got = rows(fm_dedup.dedup_substrings(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    want = plain.substring_dedup(pairs)
    assert got == want and sum(w[2] for w in want) > 500
    assert fm_dedup.dedup_substrings(nothing).count() == 0


def test_substring_dedup_of_shared_ids(spark):
    line = " ".join(f"t{i}" for i in range(30))
    docs = spark.createDataFrame([(5, line), (5, line), (7, "x " + line), (None, line), (9, line + " a"), (9, "b " + line)], "doc_id long, text string")
    got = rows(fm_dedup.dedup_substrings(docs), "doc_id", "n_removed")
    assert got == [(5, 0), (5, 0), (7, 30), (9, 30), (9, 30), (None, 30)]


def test_fm_index_counts():
    rng = np.random.default_rng(0)
    text = np.append(rng.integers(1, 4, 500), 0)
    index = fm_dedup.FMIndex(text, 4, 8)
    at = np.arange(490)
    low, high = index.window_intervals(at, 8)
    for i in at.tolist():
        count = sum((text[j:j + 8] == text[i:i + 8]).all() for j in range(493))
        assert max(1, high[i] - low[i]) == count or count == 1
    s = np.array([1, 2, 3, 1])
    assert index.tree.rank(s, np.array([501, 501, 501, 0])).tolist() == [(text == 1).sum(), (text == 2).sum(), (text == 3).sum(), 0]


# ---- op10 --------------------------------------------------------------------
def test_token_shards(docs, pairs, nothing):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    shards = simple8b.write_token_shards(docs, path, queries.END_ID, shard_ids=500)
    got = rows(simple8b.read_token_shards(shards), "doc_id", "start", "n_tokens", "ids_crc32")
    at, want = 0, []
    for i, t in pairs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [queries.END_ID]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    assert {r[0]: len(r[1]) for r in simple8b.read_token_ids(shards).collect()} == {w[0]: w[2] for w in want}
    assert simple8b.read_token_shards(simple8b.write_token_shards(nothing, path, queries.END_ID)).count() == 0


def test_token_shards_of_shared_and_null_ids(spark):
    docs = spark.createDataFrame([(2, "b"), (1, "a a"), (2, "b"), (None, "c c c")], "doc_id long, text string")
    got = rows(simple8b.read_token_shards(simple8b.write_token_shards(docs, queries.tokenizer_path(), 2)), "doc_id", "start", "n_tokens")
    assert got == [(1, 0, 3), (2, 3, 2), (2, 5, 2), (None, 7, 4)]


@pytest.mark.parametrize("top", [1, 2, 300, 49408, 2**40, 2**64])
@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_simple8b_round_trip(n, top):
    values = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64)
    values[::7] = 0
    image = simple8b.encode_shard(values)
    assert (simple8b.decode_shard(image) == values).all()
    assert (simple8b.decode_shard(image, 1, 3) == values[128:384]).all()


# ---- pipeline ----------------------------------------------------------------
def test_pipeline_keeps_what_its_stages_decide(spark):
    """Each stage against the brute-force decision on its own input."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality_rules"](spark, docs, sf)
    assert good.columns == docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r["doc_id"]: r["text"] for r in good.collect()}
    passing = {r["doc_id"] for r in docs.collect() if (m := plain.measures(r["text"]))[0] >= 20 and 100 * m[4] <= 30 * m[0]}
    assert set(kept) <= passing
    clean = [i for i in passing if labels.get(i) == 1]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)
    one = stage["simhash_near_dedup"](spark, good, sf)
    label = plain.components({i: plain.simhash(t) for i, t in kept.items()})
    assert {r["doc_id"] for r in one.collect()} == set(label.values())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    pure = stage["benchmark_decontamination"](spark, one, sf)
    want = [d[0] for d in plain.decontaminate(sorted((i, kept[i]) for i in set(label.values())), items) if not d[5]]
    assert rows(pure, "doc_id") == [(i,) for i in want]
    mixed = stage["source_mixing"](spark, pure, sf)
    assert mixed.columns == docs.columns
    out = stage["token_output"](spark, mixed, sf)
    assert out.count() == mixed.count() == len(rows(corpus_pipeline.run(spark, sf), "doc_id", "start"))
