"""Writers: dead letters, audit history, seeding, and a merge for table formats that have one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow import model
from changeflow.model import KEY

ENVELOPE = [
    "original_topic", "original_partition", "original_offset", "event_id", "reason", "reason_detail",
    "first_failed_at", "raw_payload",
]


def dlq_messages(dead: DataFrame, topic: str = model.DLQ_TOPIC) -> DataFrame:
    """Envelope rows as Kafka messages: JSON value (nulls left out), original key, two headers."""
    header = lambda name, value: F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value"))
    return dead.select(
        F.lit(topic).alias("topic"),
        "key",
        F.to_json(F.struct(*ENVELOPE)).alias("value"),
        F.array(
            header("x-dlq-reason", F.col("reason")), header("x-original-topic", F.col("original_topic"))
        ).alias("headers"),
        F.col("first_failed_at").alias("timestamp"),
    )


def write_dlq(messages: DataFrame, path: str | None = None, kafka: Mapping[str, str] | None = None) -> None:
    """Publish dead letters: to Kafka (hashed by key, acknowledged by all replicas) or to parquet."""
    if path is not None:
        messages.write.mode("overwrite").parquet(path)
        return
    if not kafka:
        raise ValueError("a path or Kafka options are required")
    messages.drop("timestamp").write.format("kafka").options(
        **{"kafka.acks": "all", "includeHeaders": "true", **kafka}
    ).save()


#: Bytes of message text that a file of the history holds, at least where a day has so many.
AUDIT_FILE_BYTES = 256 << 20
#: What a row takes beside its text.
_ROW_BYTES = 200


def audit_day() -> Column:
    return F.to_date(F.coalesce("commit_ts", "log_ts"))


def audit_bytes() -> Column:
    return F.sum(F.coalesce(F.octet_length("value"), F.lit(0)) + _ROW_BYTES)


def append_audit(
    events: DataFrame,
    root: str,
    batch_id: int,
    spark: SparkSession | None = None,
    day_bytes: Mapping | None = None,
    file_bytes: int = AUDIT_FILE_BYTES,
) -> DataFrame:
    """Add a batch to the long-term history and read it back (with ``spark``, where given).

    The batch owns its directory, so writing it again replaces it. ``event_date``
    is the partition column replay prunes on. Each date has one writer for every
    ``file_bytes`` of it, so a batch leaves as many files as it has dates, and one
    more for each such portion. ``day_bytes`` (date to bytes) is counted here
    where the caller hasn't: one entry for each date of the batch.
    """
    target = f"{root}/batch_id={batch_id}"
    dated = events.withColumn("event_date", audit_day())
    if day_bytes is None:
        day_bytes = {r[0]: r[1] for r in dated.groupBy("event_date").agg(audit_bytes()).collect()}
    salts = {day: -(-size // file_bytes) for day, size in day_bytes.items()}
    salt = F.lit(0).cast("bigint")
    for day, n in salts.items():
        if n > 1:
            salt = F.when(F.col("event_date").eqNullSafe(F.lit(day)), F.pmod(F.xxhash64("kafka_partition", "kafka_offset"), F.lit(n))).otherwise(salt)
    writers = max(1, sum(salts.values()))
    rows = dated.withColumn("_salt", salt).repartition(writers, "event_date", "_salt").drop("_salt")
    rows.write.mode("overwrite").partitionBy("event_date").parquet(target)
    return (spark or events.sparkSession).read.schema(dated.schema).parquet(target)


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root)


def seed_missing(target: DataFrame | None, source: DataFrame, now: Column) -> DataFrame:
    """Read model after "insert the source rows it lacks, leave the others alone".

    The first source row of a key wins when the source repeats it (by version,
    the lower first), as repeated inserts would find the key taken.
    """
    rows = source.groupBy(*KEY).agg(
        F.min_by(
            F.struct("available_qty", "reserved_qty", "stock_status", "row_version"), F.col("row_version")
        ).alias("_row")
    ).select(
        *KEY,
        "_row.*",
        F.concat_ws("-", F.lit("seed"), *KEY).alias("last_event_id"),
        now.alias("last_db_commit_ts"),
        now.alias("updated_at"),
    )
    columns = [f.name for f in model.STATE]
    if target is None:
        return rows.select(columns)
    missing = rows.join(target.select(*KEY), KEY, "left_anti")
    return target.select(columns).unionByName(missing.select(columns))


def merge_into_table(winners: DataFrame, table: str, keys: Sequence[str] = tuple(KEY)) -> None:
    """Version-checked upsert of one row per key into a catalog table that supports MERGE.

    For catalogs of Delta, Iceberg and the like; plain parquet uses ``state.StateTable``.
    """
    same_key = [F.col(f"{table}.{k}") == F.col(f"batch.{k}") for k in keys]
    on = same_key[0]
    for c in same_key[1:]:
        on = on & c
    newer = F.col(f"{table}.row_version") < F.col("batch.row_version")
    (
        winners.alias("batch")
        .mergeInto(table, on)
        .whenMatched(newer)
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
