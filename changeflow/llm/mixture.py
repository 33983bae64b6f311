"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document gets an exponential key whose rate is its quality weight; within a
source the smallest keys are a weighted sample without replacement. A source's
target is met by complete epochs of all its documents, and then by the documents
with the smallest keys until their sizes add up to the rest.

The prefix sum is taken in two steps, so that no source is one task's work: the
keys of a source are dealt into buckets whose number follows its rows, sums of
buckets find the bucket in which the rest runs out, and only that bucket is
sorted. What comes out is one cut for each source. Deciding a document then
needs its own key and that cut: no text is shuffled.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import SPACED_WORD, col, written

PATTERN = (5, 2, 1)
MAX_EPOCHS = 3
BUCKET_ROWS = 4_000


def size_of(text: Column) -> Column:
    """Words between white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def quality_of(text: Column) -> Column:
    """A weight from 0.1 to 1 that falls with the share of characters other than letters, space and plain marks."""
    odd = F.regexp_count(text, F.lit(r"[^\p{L}\s.,;:'-]"))
    return F.coalesce(F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(4.0) * odd / F.greatest(F.length(text), F.lit(1))), F.lit(0.1))


def sample_key(key: Column, text: Column, weight: Column, seed: int = 7) -> Column:
    """-ln(u) / weight, with u from a hash of the row: reruns agree."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, text), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / weight


def keyed(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    """(doc, source, size, sample_key) of every document."""
    return docs.select(
        col(key).alias("doc"),
        col(source).alias("source"),
        size_of(col(text)).alias("size"),
        sample_key(col(key), col(text), quality_of(col(text)), seed).alias("sample_key"),
    )


def targets(totals: DataFrame, pattern: tuple[int, ...] = PATTERN, cap: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, rows, target) from (source, source_size, rows).

    Sources by code point, null last, weigh ``pattern``, repeating. Targets add
    up to all sizes; none is above ``cap`` times its source's size, the excess
    is shared out again by weight. In order of size over weight the capped
    sources come first, so one running sum finds them all. One row per source.
    """
    place = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*map(F.lit, pattern)), F.pmod(F.row_number().over(place) - 1, F.lit(len(pattern))) + 1)
    rows = totals.withColumn("weight", weight.cast("long"))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    rows = (
        rows.withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("before", F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * cap)
        .withColumn("weight_from", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("left", F.col("all_size") - F.col("before"))
        .withColumn("capped", exact("left") * exact("weight") >= exact("source_size") * F.lit(cap) * exact("weight_from"))
        .withColumn("taken_up", F.sum(F.when(F.col("capped"), F.col("source_size") * cap).otherwise(0)).over(everything))
        .withColumn("open_weight", F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything))
    )
    target = F.when(F.col("capped"), (F.col("source_size") * cap).cast("double")).otherwise(
        (F.col("all_size") - F.col("taken_up")) * F.col("weight") / F.col("open_weight")
    )
    return rows.select("source", "source_size", "rows", target.alias("target"))


def _bucket(buckets: Column) -> Column:
    return F.floor((F.lit(1.0) - F.exp(-F.col("sample_key"))) * buckets).cast("long")


def _same_source(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["of"])


def cuts(rows: DataFrame, pattern: tuple[int, ...] = PATTERN, cap: int = MAX_EPOCHS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per source: of, source_size, target, epochs, buckets, cut_bucket, cut_key.

    Beyond complete epochs a source's documents in buckets before ``cut_bucket``
    are taken, and in it those up to ``cut_key``. The document at which the rest
    runs out is taken if that brings the sum nearer to the target.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    plan = targets(totals, pattern, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    plan = written(
        plan.withColumn("epochs", epochs).select(
            F.col("source").alias("of"), "source_size", "target", "epochs",
            (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest"),
            F.greatest(F.lit(1), F.ceil(F.col("rows") / bucket_rows)).alias("buckets"),
        ),
        "mix-plan",
    )

    placed = rows.join(plan, _same_source(rows, plan)).withColumn("bucket", _bucket(F.col("buckets")))
    sums = placed.where("rest > 0").groupBy("of", "bucket").agg(F.sum("size").alias("sum"), F.first("rest").alias("rest"))
    before = F.coalesce(F.sum("sum").over(Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    crossing = (
        sums.withColumn("before", before)
        .where("before < rest and rest <= before + sum")
        .select(F.col("of").alias("cut_of"), F.col("bucket").alias("cut_bucket"), "before")
    )
    crossing = written(crossing, "mix-crossing")

    inside = placed.join(crossing, placed["of"].eqNullSafe(crossing["cut_of"]) & (F.col("bucket") == F.col("cut_bucket")))
    units = inside.groupBy("of", "sample_key", "before", "rest").agg(F.sum("size").alias("unit"))
    reach = F.col("before") + F.coalesce(
        F.sum("unit").over(Window.partitionBy("of").orderBy("sample_key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    keys = units.where(F.col("rest") > 0).withColumn("reach", reach).where(F.col("reach") + F.col("unit") / 2 <= F.col("rest"))
    keys = keys.groupBy(F.col("of").alias("key_of")).agg(F.max("sample_key").alias("cut_key"))
    return (
        plan.join(crossing, plan["of"].eqNullSafe(crossing["cut_of"]), "left")
        .join(keys, plan["of"].eqNullSafe(keys["key_of"]), "left")
        .select("of", "source_size", "target", "epochs", "buckets", "cut_bucket", "cut_key")
    )


def _times() -> Column:
    bucket = _bucket(F.col("buckets"))
    more = (bucket < F.col("cut_bucket")) | ((bucket == F.col("cut_bucket")) & (F.col("sample_key") <= F.col("cut_key")))
    return F.col("epochs") + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)


def taken(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    pattern: tuple[int, ...] = PATTERN, cap: int = MAX_EPOCHS, seed: int = 7, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """doc_id, size, source_size, target, times and taken of every document.

    Rows alike in key and text share a sampling key and are taken together. An
    empty or null text has size 0. A source without words has target 0. Null is
    a source of its own. An empty table gives no rows.
    """
    rows = written(keyed(docs, key, text, source, seed), "mix-rows")
    plan = written(cuts(rows, pattern, cap, bucket_rows), "mix-cuts")
    return rows.join(plan, _same_source(rows, plan)).select(
        F.col("doc").alias("doc_id"), "size", "source_size", "target", _times().alias("times"), (F.col("size") * _times()).alias("taken")
    )


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    pattern: tuple[int, ...] = PATTERN, cap: int = MAX_EPOCHS, seed: int = 7, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The rows of the mix, as ``docs`` has them: a document taken twice comes twice."""
    rows = written(keyed(docs, key, text, source, seed).drop("doc"), "mix-rows")
    plan = written(cuts(rows, pattern, cap, bucket_rows), "mix-cuts")
    full = docs.select(
        F.struct(*(col(c) for c in docs.columns)).alias("packed"),
        col(source).alias("source"),
        sample_key(col(key), col(text), quality_of(col(text)), seed).alias("sample_key"),
    )
    chosen = full.join(plan, _same_source(full, plan)).select("packed", F.explode(F.array_repeat(F.lit(1), _times())))
    return chosen.select("packed.*")
