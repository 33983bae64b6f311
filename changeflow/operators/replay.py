"""Replay: history or dead letters back into the shape of the change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow import model


def replay_from_audit(audit: DataFrame, since: Column, until: Column, topic: str = model.MAIN_TOPIC) -> DataFrame:
    """History of a commit-time window as log rows, ready to publish or to resolve again.

    ``event_date`` is the history's partition column, so only the days of the
    window are read. The commit time bounds are inclusive.
    """
    return audit.filter(
        (F.col("event_date") >= F.to_date(since))
        & (F.col("event_date") <= F.to_date(until))
        & (F.col("commit_ts") >= since)
        & (F.col("commit_ts") <= until)
    ).select(
        F.lit(topic).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        "key",
        "value",
        F.col("log_ts").alias("timestamp"),
    )


def replay_count(replayed: DataFrame) -> DataFrame:
    """Dry run: how many events a replay would publish."""
    return replayed.agg(F.count(F.lit(1)).alias("events"))


def replay_dlq(
    dead: DataFrame, since: Column, republished_at: Column | None = None, topic: str = model.MAIN_TOPIC
) -> DataFrame:
    """Dead letters failed at or after ``since`` as log rows carrying their original payload."""
    return dead.filter(F.col("first_failed_at") >= since).select(
        F.lit(topic).alias("topic"),
        F.col("original_partition").alias("partition"),
        F.col("original_offset").alias("offset"),
        "key",
        F.col("raw_payload").alias("value"),
        (F.col("first_failed_at") if republished_at is None else republished_at).alias("timestamp"),
    )


def first_failures(dead: DataFrame) -> DataFrame:
    """Earliest failure per message; a redelivered dead letter is stamped again each time."""
    return dead.groupBy("original_topic", "original_partition", "original_offset").agg(
        F.min("first_failed_at").alias("first_failed_at"), F.count(F.lit(1)).alias("deliveries")
    )
