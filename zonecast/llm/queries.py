"""Registered queries of the corpus operators and their DuckDB twins.

Each query applies one operator with production parameters to its whole
table; the columns are what the operator returns, or digests of it.
"""
from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import (
    fm_dedup, html_blocks, impact_search, license_scan, line_dedup, periodic_runs, phrase_index, phrase_mining, quality_ngrams, simhash_pivots,
    simple8b, source_mix, suffix_tree_lm,
)
from zonecast.llm.common import documents_view, store, texts_of

QueryFn = Callable[[SparkSession, str], DataFrame]

#: Token ids: the tokenizer's file and the id that ends a document.
TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract_pages(_table(spark, sf_dir, "pages"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.score_documents(_table(spark, sf_dir, "documents"))


def op4_phrase_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        phrase_index.items_digest("item_ids").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix_sizes(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_pivots.simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: a folder per source, in it one per language other
    than English; a document without a source has a folder of its own."""
    parts = [F.coalesce("source", F.concat(F.lit("unsourced-"), F.col("doc_id").cast("string"))), F.when(F.col("lang") != "en", F.col("lang")), F.col("doc_id").cast("string")]
    path = F.when(F.col("source").isNotNull() | F.col("doc_id").isNotNull(), F.concat_ws("/", *parts))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), path.alias("path"), F.col("text").cast("string").alias("text"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan.scan_own(document_files(_table(spark, sf_dir, "documents")))
    files = store(scanned, "scanned-files")
    # a licence file is a document that holds hardly anything but the licence; a notice in running text speaks for that text alone
    found = license_scan.inherit(files, F.col("coverage") >= 0.8)
    return found.select("doc_id", "path", "own", "licence", "origin", F.round("similarity", 6).alias("similarity"), F.round("coverage", 6).alias("coverage"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_ngrams.train_quality(docs, _table(spark, sf_dir, "labels"))
    scored = quality_ngrams.score_quality(docs, model)
    return scored.select("doc_id", *quality_ngrams.MEASURES, "base_failed", "kept", F.round("probability", 6).alias("probability"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.dedup_substrings(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = simple8b.write_token_shards(_table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)
    return simple8b.read_token_shards(shards)


def op11_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = impact_search.search_vectors(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", "score")


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where every tenth document by the checksum of
    its id repeats a stretch of its words up to its end. A null id has no
    checksum, its text stays as it is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), texts_of(batch)
            for t, doc in enumerate(ids):
                h = zlib.crc32(str(doc).encode()) if doc is not None else 1
                if h % 10 == 0 and (words := texts[t].split()):
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    texts[t] = b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return documents_view(docs).mapInArrow(work, "doc_id long, text string")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(with_periodic_tails(_table(spark, sf_dir, "documents")))
    size = F.size("runs").cast("long")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("low"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("*", best.alias("best")).select(
        "doc_id", size.alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.low")).alias("period"),
        F.expr("1000 * best.length div -best.low").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_mining.mine_phrases(_table(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES: dict[str, QueryFn] = {
    f.__name__: f
    for f in (
        op1_html_blocks, op2_line_dedup, op3_suffix_tree_lm, op4_phrase_decontamination, op5_source_mix, op6_simhash_pivots,
        op7_license_scan, op8_quality_rules, op9_substring_dedup, op10_token_shards, op11_impact_search, op12_periodic_runs, op13_phrase_mining,
    )
}

# ---- DuckDB twins ------------------------------------------------------------
_SPACE = r"\x20\x09-\x0D"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP2_SQL = rf"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM split),
keyed AS (SELECT *, translate(regexp_replace(line, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g'), {_LOWER}) AS k FROM lines),
shared AS (SELECT k, min(doc_id) AS first_id FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING min(doc_id) < max(doc_id)),
marked AS (SELECT keyed.*, coalesce(doc_id > first_id, false) AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

_WORDS4 = r"regexp_extract_all(translate(coalesce(text, ''), " + _LOWER + r"), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP4_SQL = rf"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS4} AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(10, len(ws)) AS k, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS w
  FROM (SELECT item, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM items WHERE len(ws) > 0)),
docs AS (SELECT doc_id, {_WORDS4} AS ws FROM documents),
doc_windows AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM item_windows) WHERE len(ws) >= k)),
hits AS (SELECT doc_id, i, k, item FROM doc_windows JOIN item_windows USING (k, w)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(n.n, 0) AS n_items,
       sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN named n ON n.doc_id = d.doc_id"""

OP9_SQL = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') AS ws FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM docs WHERE len(ws) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS nth FROM wins) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM docs),
kept AS (
  SELECT words.doc_id, count(gone.p) AS n_removed, string_agg(words.w, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL) AS t
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id"""

OP11_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
           FROM v AS q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

# the checksum of the id, bit by bit: a byte is mixed in (>= 0), then eight shifts (-1)
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
  lambda i: [CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"""
OP12_SQL = rf"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') AS ws, {_CRC} AS h FROM documents),
sized AS (SELECT *, len(ws) AS n, h // 10 AS g FROM split),
cut AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM sized),
tail AS (SELECT doc_id, ws, n, a, 1 + (n - a) // (3 + g % 8) AS p FROM cut),
words AS (SELECT doc_id, i, ws[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS w FROM (SELECT *, unnest(range(n)) AS i FROM tail)),
fives AS (
  SELECT doc_id, i, w, w || chr(10) || lead(w) OVER d || chr(10) || lead(w, 2) OVER d || chr(10) || lead(w, 3) OVER d || chr(10) || lead(w, 4) OVER d AS five
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
steps AS (SELECT DISTINCT x.doc_id, y.i - x.i AS q FROM fives x JOIN fives y ON x.doc_id = y.doc_id AND x.five = y.five AND y.i > x.i),
twins AS (SELECT x.doc_id, s.q, x.i FROM steps s JOIN words x ON x.doc_id = s.doc_id JOIN words y ON y.doc_id = s.doc_id AND y.i = x.i + s.q AND y.w = x.w),
isles AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS isle FROM twins),
found AS (SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM isles GROUP BY doc_id, q, isle HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM found GROUP BY ALL),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
told AS (
  SELECT doc_id, count(*) AS n_runs, max(length) AS most, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t
  FROM runs GROUP BY doc_id),
best AS (SELECT doc_id, start, length, period FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS nth FROM runs) WHERE nth = 1)
SELECT d.doc_id, coalesce(t.n_runs, 0) AS n_runs, b.start, CAST(b.length AS BIGINT) AS length, b.period, CAST(1000 * b.length // b.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(t.t, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM documents d LEFT JOIN told t ON t.doc_id = d.doc_id LEFT JOIN best b ON b.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id"""

OP13_SQL = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM split GROUP BY lang),
counts AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM split, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(ws) >= k) GROUP BY ALL),
phrases AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(ws[:cut], ' ') AS left_part, array_to_string(ws[cut + 1:], ' ') AS right_part
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM phrases)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.left_part JOIN counts y ON y.lang = c.lang AND y.phrase = c.right_part),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM scored) WHERE nth = 1),
around AS (SELECT lang, array_to_string(ws[i:i + 1], ' ') AS phrase, max(a) AS longer FROM (SELECT *, unnest([1, 2]) AS i FROM phrases WHERE k = 3) GROUP BY ALL),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.longer IS NULL OR 100 * o.longer < 50 * b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

ORACLE: dict[str, str] = {
    "op2_line_dedup": OP2_SQL, "op4_phrase_decontamination": OP4_SQL, "op9_substring_dedup": OP9_SQL, "op11_impact_search": OP11_SQL, "op12_periodic_runs": OP12_SQL,
    "op13_phrase_mining": OP13_SQL,
}


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
