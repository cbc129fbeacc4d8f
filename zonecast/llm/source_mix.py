"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key scaled by its quality weight, sources
are read in key order and cut where the prefix sum of sizes reaches the
source's budget; complete epochs come before the fractional selection. Only
DataFrame functions are used.

The order within a source is never sorted as a whole: keys fall into
``BUCKETS`` ordered buckets, prefix sums run over bucket sums (at most
``BUCKETS`` rows a source), and only the bucket in which the budget ends is
ordered row by row. A source that holds a third of all rows therefore adds to
partial sums and has one small bucket sorted.

Defined cases: a null or empty text has size 0 and is taken 0 times its size;
the null source is a source of its own, ordered last; a source of size 0 gets
target 0; repeated rows are rows of their own; ties in the key are ordered by
id (null first) and size; an empty table gives no rows; columns other than
``doc_id``, ``text``, ``source`` are ignored by ``mix_sizes`` and kept by
``mix_documents``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import store

#: Weights of sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: A source is repeated at most so many times.
MAX_EPOCHS = 3
#: Ordered key buckets per source.
BUCKETS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def symbol_weight(text: Column) -> Column:
    """Quality weight in (0, 1]: the fewer symbols among the characters, the
    nearer to 1."""
    chars = F.greatest(F.length(text), F.lit(1))
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.coalesce(1.0 / (1.0 + 20.0 * symbols / chars), F.lit(1.0))


def sampling_key(weight: Column, *identity: Column, seed: int = 0) -> Column:
    """-ln(u) / weight with u from a hash of the identity: the same in every
    run and on every partitioning."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *identity), 11).cast("double") + F.lit(0.5)) / F.lit(float(2**53))
    return -F.log(u) / weight


def key_bucket(key: Column) -> Column:
    return F.least(F.floor((1.0 - F.exp(-key)) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")


def _ranked(sources: DataFrame) -> DataFrame:
    """``rank`` (from 0) of each source in code point order, null last: range
    partitions ranked on their own, then shifted by the sizes before."""
    order = [F.col("source").isNull(), F.col("source")]
    dealt = store(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = dealt.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("part").orderBy(*order)
    return dealt.withColumn("nth", F.row_number().over(within) - 1).join(shift, "part").select(
        "source", "source_size", (F.col("nth") + F.col("shift")).alias("rank")
    )


def source_targets(totals: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source``, ``source_size``, ``target`` from ``source``, ``source_size``.

    All sizes are shared by weight; what would exceed ``max_epochs`` times a
    source's size is shared among the others, until none is above. Each round
    is one aggregate over sources; at least one source is capped in each but
    the last.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    table = store(
        _ranked(totals).select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(max_epochs)).alias("cap")),
        "mix-weights",
    )
    total = table.agg(F.sum("source_size")).first()[0] or 0
    scale = 0.0
    while True:
        # capped at this scale: filling up raises the scale, so a capped source stays capped
        capped = F.col("weight") * F.lit(scale) >= F.col("cap") if scale else F.lit(False)
        row = table.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        if not row[1]:
            break
        new = (total - row[0]) / row[1]
        if new <= scale:
            break
        scale = new
    return table.select("source", "source_size", F.least(F.col("cap"), F.col("weight") * F.lit(scale)).alias("target"))


def mix_plan(rows: DataFrame, **shares) -> DataFrame:
    """One row per source: target, complete ``epochs``, the ``budget`` of the
    fractional one, the ``bucket`` where it ends and the size ``before`` it.

    ``rows`` has ``source``, ``size``, ``key``.
    """
    buckets = store(
        rows.groupBy("source", key_bucket(F.col("key")).alias("bucket")).agg(F.sum("size").alias("bucket_size")), "mix-buckets"
    )
    targets = source_targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), **shares)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("epochs", whole).withColumn(
        "budget", F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5).cast("long")
    )
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = buckets.withColumn("before", F.coalesce(F.sum("bucket_size").over(running), F.lit(0)))
    right = placed.select(F.col("source").alias("_s"), "bucket", "bucket_size", "before")
    ends = targets.join(right, F.col("source").eqNullSafe(F.col("_s")))
    last = F.when(F.col("before") + F.col("bucket_size") > F.col("budget"), F.struct("bucket", "before"))
    return store(
        ends.groupBy("source", "source_size", "target", "epochs", "budget").agg(F.min(last).alias("end"))
        .select("source", "source_size", "target", "epochs", "budget",
                F.coalesce("end.bucket", F.lit(BUCKETS)).alias("end_bucket"), F.coalesce("end.before", F.lit(0)).alias("end_before")),
        "mix-plan",
    )


def mix_rows(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with ``source_size``, ``target``, ``epochs`` and ``part``: the
    words taken in the fractional epoch. ``rows`` has ``doc_id``, ``source``,
    ``size``, ``key`` and any other columns."""
    named = plan.select(F.col("source").alias("_zc_source"), *[c for c in plan.columns if c != "source"])
    # the plan is a written table: below the broadcast threshold it is broadcast, above it a
    # sort-merge join follows, whose hot sources adaptive execution splits
    joined = rows.join(named, rows["source"].eqNullSafe(named["_zc_source"])).withColumn("_zc_bucket", key_bucket(F.col("key")))
    part = F.when(F.col("_zc_bucket") < F.col("end_bucket"), F.col("size")).otherwise(F.lit(0).cast("long"))
    plain = joined.where(F.col("_zc_bucket") != F.col("end_bucket")).withColumn("part", part)
    running = Window.partitionBy("_zc_source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("end_before") + F.coalesce(F.sum("size").over(running), F.lit(0))
    edge = joined.where(F.col("_zc_bucket") == F.col("end_bucket")).withColumn(
        "part", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("budget") - ahead))
    )
    return plain.unionByName(edge).drop("_zc_source", "_zc_bucket")


def sized_documents(docs: DataFrame, *, seed: int = 0) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``key`` of every row, written once."""
    text = F.col("text").cast("string")
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(text).alias("size"), symbol_weight(text).alias("weight"),
    )
    key = sampling_key(F.col("weight"), F.col("doc_id"), F.col("source"), F.col("size"), seed=seed)
    return store(base.select("doc_id", "source", "size", key.alias("key")), "mix-sizes")


def mix_sizes(docs: DataFrame, *, seed: int = 0, **shares) -> DataFrame:
    """Per document ``doc_id``, ``source``, ``size``, ``source_size``,
    ``target`` and ``taken``: words in the mix, repeats counted. The document
    in which the budget ends is taken in part."""
    rows = sized_documents(docs, seed=seed)
    mixed = mix_rows(rows, mix_plan(rows, **shares))
    return mixed.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken")
    )


def mix_documents(docs: DataFrame, *, seed: int = 0, **shares) -> DataFrame:
    """The mixed documents themselves, all columns: each row as often as it is
    taken. Texts stay whole: the document in which a budget ends is taken when
    at least half of it fits."""
    text = F.col("_zc_text")
    keep = [F.col(f"`{c}`").alias(f"_zc_c{i}") for i, c in enumerate(docs.columns)]
    view = docs.select(
        *keep, F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("_zc_text"),
    )
    rows = view.withColumn("size", word_count(text)).withColumn(
        "key", sampling_key(symbol_weight(text), F.col("doc_id"), F.col("source"), F.col("size"), seed=seed)
    ).drop("_zc_text")
    plan = mix_plan(sized_documents(docs, seed=seed), **shares)
    copies = F.col("epochs") + F.when((F.col("size") > 0) & (2 * F.col("part") >= F.col("size")), 1).otherwise(0)
    mixed = mix_rows(rows, plan).withColumn("_zc_copies", copies.cast("int"))
    repeated = mixed.withColumn("_zc_copy", F.explode(F.array_repeat(F.lit(0), F.col("_zc_copies"))))
    return repeated.select(*[F.col(f"_zc_c{i}").alias(c) for i, c in enumerate(docs.columns)])
