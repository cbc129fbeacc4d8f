"""From documents to token shards: five stages, each on what the one before
kept, each written as Parquet and read again."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonecast.llm import phrase_index, quality_ngrams, simhash_pivots, simple8b, source_mix
from zonecast.llm.common import store
from zonecast.llm.queries import END_ID, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the model reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_ngrams.keep_good(docs, quality_ngrams.train_quality(docs, labels))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash_pivots.keep_one_per_component(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return phrase_index.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return source_mix.mix_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards, read back: one row per document row."""
    return simple8b.read_token_shards(simple8b.write_token_shards(docs, tokenizer_path(), END_ID))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: The classifier, XXH64 and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
