"""Stock tables and bench records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow import model

# --- fixed values: names the connector puts into the source block ----------------------------------
SOURCE_DB = "warehouse"
SOURCE_SCHEMA = "public"
SOURCE_TABLE = "warehouse_inventory"


def read_source_table(
    spark: SparkSession, path: str | None = None, jdbc: Mapping[str, str] | None = None
) -> DataFrame:
    """The source table from parquet, or over JDBC.

    For a large table pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` among the JDBC options, so that the scan is split.
    """
    if path is not None:
        return spark.read.parquet(path)
    if not jdbc or not jdbc.get("url"):
        raise ValueError("a path or JDBC options with a url are required")
    return spark.read.format("jdbc").options(**{"dbtable": SOURCE_TABLE, **jdbc}).load()


def snapshot_to_events(
    table: DataFrame, taken_at: Column, lsn: int = 0, tx_id: int = 0, topic: str = model.MAIN_TOPIC
) -> DataFrame:
    """Initial snapshot: every table row as a log message with operation ``r``.

    All rows share one log position, so their event ids are equal; keys tell them
    apart. Offset -1 puts the snapshot ahead of the log it is unioned with.
    """
    at_ms = F.unix_millis(taken_at)
    message = F.to_json(
        F.struct(
            F.lit(model.OP_SNAPSHOT).alias("op"),
            at_ms.alias("ts_ms"),
            F.struct(
                F.lit(SOURCE_DB).alias("db"),
                F.lit(SOURCE_SCHEMA).alias("schema"),
                F.lit(SOURCE_TABLE).alias("table"),
                F.lit(tx_id).cast("bigint").alias("txId"),
                F.lit(lsn).cast("bigint").alias("lsn"),
                at_ms.alias("ts_ms"),
            ).alias("source"),
            F.struct(
                "product_id", "warehouse_id", "available_qty", "reserved_qty", "stock_status", "row_version"
            ).alias("after"),
        )
    )
    return table.select(
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(-1).cast("bigint").alias("offset"),
        F.col("product_id").alias("key"),
        message.alias("value"),
        taken_at.alias("timestamp"),
    )


def read_bench_runs(
    spark: SparkSession, directory: str, pattern: str = "*.json"
) -> tuple[DataFrame, DataFrame]:
    """(run records, files that are not valid JSON): a malformed file is reported and skipped.

    One document per file, each a few lines long, so a file is read as one text.
    """
    schema = model.BENCH_RUN.simpleString()[len("struct<"):-1].replace(":", " ")
    run = F.from_json(
        "value", f"{schema}, _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    read = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .text(directory, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file"), run.alias("run"))
    )
    malformed = F.col("run").isNull() | F.col("run._corrupt").isNotNull()
    good = read.filter(~malformed).select(*[F.col(f"run.{f.name}").alias(f.name) for f in model.BENCH_RUN])
    return good, read.filter(malformed).select("file")
