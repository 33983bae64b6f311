"""Is every committed offset accounted for? Missing ranges, offsets with several results, and sums by partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTITION = ["topic", "partition"]
#: Offsets of a block: a partition's rows are never one task's work, only a block's are.
BLOCK_OFFSETS = 1_000_000


def _deliveries(outcomes: DataFrame) -> DataFrame:
    """One row for each offset: how often it was counted, and with how many different results."""
    return outcomes.groupBy(*PARTITION, "offset").agg(
        F.count(F.lit(1)).alias("deliveries"), F.count_distinct("result").alias("results")
    )


def offset_gaps(outcomes: DataFrame, expected: DataFrame | None = None, block_offsets: int = BLOCK_OFFSETS) -> DataFrame:
    """(topic, partition, from_offset, to_offset, missing): ranges of offsets that no outcome has.

    ``outcomes`` has topic, partition, offset and result of every message.
    ``expected`` gives the log's ``first_offset`` and ``end_offset`` for each
    partition; without it only gaps between counted offsets are found, with it also
    those at the ends and partitions without any outcome.

    Islands are cut at block borders: inside a block an offset is compared with the
    one before it, between blocks the ends of neighbouring blocks are.
    """
    cut = _deliveries(outcomes).select(*PARTITION, "offset", F.floor(F.col("offset") / block_offsets).cast("bigint").alias("_block"))
    inside = Window.partitionBy(*PARTITION, "_block").orderBy("offset")
    within = cut.select(*PARTITION, F.lag("offset").over(inside).alias("_before"), F.col("offset").alias("_after"))
    ends = cut.groupBy(*PARTITION, "_block").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"))
    if expected is not None:  # what precedes the log's first offset and follows its last one are blocks of their own
        first = expected.select(*PARTITION, (F.col("first_offset") - 1).alias("lo"))
        last = expected.select(*PARTITION, (F.col("end_offset") + 1).alias("lo"))
        ends = ends.select(*PARTITION, "lo", "hi").unionByName(first.unionByName(last).withColumn("hi", F.col("lo")))
    blocks_in_order = Window.partitionBy(*PARTITION).orderBy("lo")
    between = ends.select(*PARTITION, F.lag("hi").over(blocks_in_order).alias("_before"), F.col("lo").alias("_after"))
    gaps = within.unionByName(between).filter(F.col("_after") - F.col("_before") > 1)
    return gaps.select(
        *PARTITION,
        (F.col("_before") + 1).alias("from_offset"),
        (F.col("_after") - 1).alias("to_offset"),
        (F.col("_after") - F.col("_before") - 1).alias("missing"),
    )


def repeated_offsets(outcomes: DataFrame) -> DataFrame:
    """Offsets counted more than once: (topic, partition, offset, deliveries, results)."""
    return _deliveries(outcomes).filter("deliveries > 1")


def conservation(outcomes: DataFrame, expected: DataFrame, results: Sequence[str], block_offsets: int = BLOCK_OFFSETS) -> DataFrame:
    """For each partition what its log holds and what became of it.

    expected (offsets of the log), accounted (different offsets counted), missing,
    repeated (offsets counted more than once), conflicting (with different
    results), received (all outcomes), a column for each result, and ``conserved``:
    nothing is missing or repeated, and the results add up to the received ones.
    """
    counted = _deliveries(outcomes).groupBy(*PARTITION).agg(
        F.count(F.lit(1)).alias("accounted"),
        F.count_if(F.col("deliveries") > 1).alias("repeated"),
        F.count_if(F.col("results") > 1).alias("conflicting"),
    )
    sums = outcomes.groupBy(*PARTITION).agg(
        F.count(F.lit(1)).alias("received"), *[F.count_if(F.col("result") == r).alias(r) for r in results]
    )
    lost = offset_gaps(outcomes, expected, block_offsets).groupBy(*PARTITION).agg(F.sum("missing").alias("missing"))
    size = (F.col("end_offset") - F.col("first_offset") + 1).alias("expected")
    rows = expected.select(*PARTITION, size).join(counted, PARTITION, "left").join(sums, PARTITION, "left").join(lost, PARTITION, "left")
    rows = rows.fillna(0)
    added = sum((F.col(r) for r in results), F.lit(0))
    whole = (F.col("missing") == 0) & (F.col("repeated") == 0) & (added == F.col("received"))
    return rows.select(
        *PARTITION, "expected", "accounted", "missing", "repeated", "conflicting", "received", *results, whole.alias("conserved")
    )


def no_silent_loss(partitions: DataFrame) -> DataFrame:
    """The objective as a row (slo, value, target, met): offsets of the log without an outcome, none allowed."""
    lost = partitions.agg(F.coalesce(F.sum("missing"), F.lit(0)).cast("double").alias("value"))
    return lost.select(F.lit("no_silent_loss").alias("slo"), "value", F.lit(0.0).alias("target"), (F.col("value") == 0).alias("met"))
