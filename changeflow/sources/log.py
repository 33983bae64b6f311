"""The change log: Kafka where its connector is installed, files of the same shape elsewhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow import model
from changeflow.functions.decode import MALFORMED, parse

# --- fixed values: fetch settings of the consumer ------------------------------------------------
TRIGGER = "500 milliseconds"
# A fetch waits for 10,000 bytes, some 25 messages, or half a second.
MIN_OFFSETS, MAX_DELAY = 25, "500ms"


def read_log(
    spark: SparkSession,
    path: str | None = None,
    *,
    brokers: Sequence[str] = (),
    topic: str | None = None,
    group_id: str | None = None,
    streaming: bool = False,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_offsets_per_trigger: int | None = MIN_OFFSETS,
    max_trigger_delay: str = MAX_DELAY,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Log rows (``model.LOG``) from parquet files or from Kafka, as a batch or a stream.

    A new consumer group starts at the latest offset, as the stream does here;
    afterwards the checkpoint holds the position. A Kafka batch read covers the
    whole retained log. A stream waits for ``min_offsets_per_trigger`` messages, but
    no longer than ``max_trigger_delay``, so that few messages don't make many batches.
    """
    if path is not None:
        if not streaming:
            return spark.read.schema(model.LOG).parquet(path)
        reader = spark.readStream.schema(model.LOG)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.parquet(path)

    if not brokers:
        raise ValueError("no brokers configured")
    if not topic or not group_id:
        raise ValueError("topic and group_id required")
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = (
        reader.option("kafka.bootstrap.servers", ",".join(brokers))
        .option("subscribe", topic)
        .option("groupIdPrefix", group_id)
        .option("includeHeaders", "false")
    )
    if streaming:
        reader = reader.option("startingOffsets", starting_offsets).option("failOnDataLoss", "true")
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        if min_offsets_per_trigger:
            if max_offsets_per_trigger and min_offsets_per_trigger > max_offsets_per_trigger:
                raise ValueError("min_offsets_per_trigger exceeds max_offsets_per_trigger")
            reader = reader.option("minOffsetsPerTrigger", min_offsets_per_trigger).option("maxTriggerDelay", max_trigger_delay)
    return reader.load().select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
    )


def route_topic(log: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """Rename the topics that match the pattern as a whole; the others stay."""
    whole = f"^(?:{pattern})$"
    return log.withColumn(
        "topic",
        F.when(F.col("topic").rlike(whole), F.regexp_replace("topic", whole, replacement)).otherwise(F.col("topic")),
    )


def capture_columns(events: DataFrame, tables: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Scope of capture on decoded events: the listed ``schema.table`` names, the listed row columns."""
    kept = [c for c in ("available_qty", "reserved_qty", "stock_status", "row_version") if c in columns]

    def narrow(side: str) -> Column:
        return F.when(
            F.col(side).isNotNull(), F.struct(*[F.col(f"{side}.{c}").alias(c) for c in kept])
        ).alias(side)

    scoped = events.filter(F.concat_ws(".", "source.schema", "source.table").isin(list(tables)))
    return scoped.select(*[narrow(c) if c in ("before", "after") else F.col(c) for c in events.columns])


def tolerant_parse(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable messages, unreadable ones with context headers): errors are set aside, never fatal.

    Only the JSON syntax is judged here; what the message means is for the gates.
    """
    json = parse(F.col("value"), {"op": "STRING"})
    tested = log.withColumn("_json", json).withColumn(
        "_bad",
        F.col("value").isNotNull()
        & ((F.length("value") == 0) | (F.coalesce(F.size("_json.v"), F.lit(-1)) != 1)),
    ).drop("_json")
    good = tested.filter(~F.coalesce(F.col("_bad"), F.lit(False))).drop("_bad")
    dead = tested.filter("_bad").select(
        "topic",
        "partition",
        "offset",
        "key",
        "value",
        "timestamp",
        F.create_map(
            F.lit("__connect.errors.topic"), F.col("topic"),
            F.lit("__connect.errors.partition"), F.col("partition").cast("string"),
            F.lit("__connect.errors.offset"), F.col("offset").cast("string"),
            F.lit("__connect.errors.stage"), F.lit("VALUE_CONVERTER"),
            F.lit("__connect.errors.exception.message"), F.lit(MALFORMED),
        ).alias("headers"),
    )
    return good, dead
