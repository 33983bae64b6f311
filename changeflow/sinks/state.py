"""The read model and the marks as plain partitioned parquet.

The read model is partitioned by a hash of the key. A batch reads the partitions it
touches, writes their new content to a staged copy, and overwrites just these
partitions from there (Spark's dynamic partition overwrite). Between the two
nothing is lost: a batch that runs again finds its staged copy whole and repeats
the second step, which may be repeated at will.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow import model
from changeflow.model import KEY
from changeflow.session import delete, exists, folders


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


class StateTable:
    """``buckets`` fixes the number of partitions: choose it so that one is one task's work."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.table, self.layout = f"{self.root}/table", f"{self.root}/layout"

    def bucket_of(self) -> Column:
        # The state has one row per key, so buckets of hashed keys are even.
        return F.pmod(F.xxhash64(*KEY), F.lit(self.buckets)).cast("int")

    def _check(self) -> None:
        """A key's partition depends on their number, so a table keeps the one it was made with."""
        if not exists(self.spark, f"{self.layout}/_SUCCESS"):
            made = self.spark.range(1, numPartitions=1).select(F.lit(self.buckets).alias("buckets"))
            made.write.mode("overwrite").parquet(self.layout)
        else:
            made = self.spark.read.schema("buckets INT").parquet(self.layout).first().buckets
            if made != self.buckets:
                raise ValueError(f"{self.root} has {made} buckets, not {self.buckets}")

    def touched(self, events: DataFrame) -> list[int]:
        """Buckets the events fall into; at most ``buckets`` entries."""
        return [r[0] for r in events.select(self.bucket_of().alias("b")).distinct().collect()]

    def read(self, only: list[int] | None = None) -> DataFrame:
        """State rows (of the listed buckets)."""
        self._check()
        if not exists(self.spark, self.table):
            return self.spark.createDataFrame([], model.STATE)
        rows = self.spark.read.schema(_ddl(model.STATE) + ", bucket INT").parquet(self.table)
        if only is not None:
            rows = rows.filter(F.col("bucket").isin(only))
        return rows.select([f.name for f in model.STATE])

    def _staged(self, batch_id: int) -> str:
        return f"{self.root}/staged/batch={batch_id}"

    def is_staged(self, batch_id: int) -> bool:
        return exists(self.spark, f"{self._staged(batch_id)}/_SUCCESS")

    def stage(self, batch_id: int, content: DataFrame) -> None:
        """Write what the batch's partitions will hold; ``content`` has all their rows."""
        self._check()
        (
            content.select([f.name for f in model.STATE])
            .withColumn("bucket", self.bucket_of())
            .repartition("bucket")
            .sortWithinPartitions("bucket", *KEY)
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(self._staged(batch_id))
        )

    def swap(self, batch_id: int) -> None:
        """Overwrite the staged partitions in the table; staged copies of earlier batches go."""
        staged = self.spark.read.schema(_ddl(model.STATE) + ", bucket INT").parquet(self._staged(batch_id))
        writer = staged.repartition("bucket").sortWithinPartitions("bucket", *KEY).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.table)
        for name in folders(self.spark, f"{self.root}/staged"):
            if name.startswith("batch=") and int(name[len("batch="):]) < batch_id:
                delete(self.spark, f"{self.root}/staged/{name}")

    def replace(self, batch_id: int, content: DataFrame) -> None:
        """Stage and swap. A batch that was staged before only swaps: the table may hold a part of it by now,
        so ``content`` derived from it isn't asked for."""
        if not self.is_staged(batch_id):
            self.stage(batch_id, content)
        self.swap(batch_id)


class MarkTable:
    """Marks of applied ids, by the day of the mark and a hash of the id.

    A batch appends to the partitions it touches. Writing it again adds the same
    rows once more, which changes nothing: of an id's marks the latest counts, and
    a batch doesn't read its own.
    """

    def __init__(self, spark: SparkSession, root: str, ttl_seconds: int = model.MARK_TTL_SECONDS, buckets: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.ttl_seconds = ttl_seconds
        self.buckets = buckets

    def bucket_of(self) -> Column:
        # By the id alone: a repeat may come on another key.
        return F.pmod(F.xxhash64("event_id"), F.lit(self.buckets)).cast("int")

    def _oldest_day(self, earliest_log_second: int) -> int:
        return (earliest_log_second - self.ttl_seconds) // 86400

    def read(self, before: int, earliest_log_second: int, only: list[int] | None = None) -> DataFrame | None:
        """Marks of earlier batches that may still be alive, of the listed buckets; dead days are not read."""
        if not exists(self.spark, self.root):
            return None
        marks = self.spark.read.schema(_ddl(model.MARKS) + ", batch BIGINT, mark_day BIGINT, bucket INT").parquet(self.root)
        alive = marks.filter((F.col("mark_day") >= self._oldest_day(earliest_log_second)) & (F.col("batch") < before))
        if only is not None:
            alive = alive.filter(F.col("bucket").isin(only))
        return alive.select([f.name for f in model.MARKS])

    def write(self, batch_id: int, marks: DataFrame) -> None:
        day = F.floor(F.unix_seconds("marked_at") / 86400).cast("bigint")
        rows = marks.select([f.name for f in model.MARKS]).withColumns(
            {"batch": F.lit(batch_id).cast("bigint"), "mark_day": day, "bucket": self.bucket_of()}
        )
        rows.repartition("mark_day", "bucket").write.mode("append").partitionBy("mark_day", "bucket").parquet(self.root)

    def forget(self, earliest_log_second: int) -> list[int]:
        """Delete the days whose marks are all dead for events from this second on; the days deleted."""
        oldest, gone = self._oldest_day(earliest_log_second), []
        for name in folders(self.spark, self.root):
            if name.startswith("mark_day=") and int(name[len("mark_day="):]) < oldest:
                delete(self.spark, f"{self.root}/{name}")
                gone.append(int(name[len("mark_day="):]))
        return sorted(gone)
