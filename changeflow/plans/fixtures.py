"""Inputs derived from the raw tables: the change log, stock tables, reservations, movements.

The rules are those of FIXTURES.md; the oracle SQL recomputes every result from
the same rules on flat columns, without reading the JSON text built here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow import model
from changeflow.operators.blocks import running
from changeflow.session import stage, use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``seq`` = position within (user, n mod 3), counted block by block."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("n"),
        "user_id",
        "event_type",
        F.floor("value").cast("int").alias("qty"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("commit_ms"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("iso"),
        F.pmod(F.col("event_id"), F.lit(3)).alias("wh"),
    )
    return running(
        events, ["user_id", "wh"], "n", {"seq": ("sum", F.lit(1))}
    )


def build_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a Kafka-shaped log with both envelopes, repeats, late repeats, reused ids and broken messages."""
    use_utc(spark)
    shaped = (
        _numbered_events(spark, sf_dir)
        .withColumn("ver", F.expr("2 * seq + (n * 7919) % 7"))
        .withColumn(
            "op",
            F.expr("CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END"),
        )
        .withColumn("pid", F.expr("CASE WHEN n % 89 = 7 THEN '' ELSE concat('SKU-', user_id) END"))
        .withColumn("wid", F.expr("concat('WH-', wh)"))
        .withColumn(
            "eid",
            F.expr(
                """CASE WHEN seq % 7 IN (2, 3) THEN concat('U', user_id, '-', wh, '-', seq DIV 7)
                WHEN seq % 11 = 5 THEN concat('X', user_id, '-', seq) ELSE concat('E', n) END"""
            ),
        )
        .withColumn("ver", F.expr("CASE WHEN n % 79 = 5 THEN 0 ELSE ver END"))
        .withColumn(
            "img",
            F.expr(
                """CASE WHEN n % 2 = 0 THEN concat('{"available_qty":', qty, ',"row_version":', ver, '}')
                ELSE concat('{"product_id":"', pid, '","warehouse_id":"', wid, '","available_qty":', qty,
                  ',"reserved_qty":', n % 5, ',"stock_status":"', CASE WHEN qty = 0 THEN 'OOS' ELSE 'ACTIVE' END,
                  '","row_version":', ver, '}') END"""
            ),
        )
        .withColumn(
            "full_value",
            F.expr(
                """CASE WHEN n % 2 = 0 THEN concat('{"event_id":"', eid, '","event_time":"', iso, '","op":"', op,
                  '","product_id":"', pid, '","warehouse_id":"', wid, '","schema_version":"',
                  CASE WHEN n % 83 < 4 THEN 'v2' ELSE 'v3' END, '","',
                  CASE WHEN op = 'd' THEN 'before' ELSE 'after' END, '":', img, '}')
                ELSE concat('{"op":"', op, '","ts_ms":', commit_ms + 30,
                  ',"source":{"db":"warehouse","schema":"public","table":"warehouse_inventory","txId":', n,
                  CASE WHEN n % 40 = 3 THEN '' WHEN n % 40 = 7 THEN ',"lsn":null' WHEN n % 4 = 3 THEN concat(',"lsn":"', n * 8, '"')
                    ELSE concat(',"lsn":', n * 8) END, ',"ts_ms":', commit_ms,
                  '},"before":', CASE WHEN op = 'd' THEN img ELSE 'null' END,
                  ',"after":', CASE WHEN op = 'd' THEN 'null' ELSE img END, '}') END"""
            ),
        )
        .withColumn(
            "value", F.expr("CASE WHEN n % 97 = 13 THEN left(full_value, length(full_value) - 5) ELSE full_value END")
        )
    )
    first = F.expr("named_struct('off', n * 10, 'ms', commit_ms + (n * 37) % 8000)")
    repeat = F.expr("IF(n % 50 = 0, named_struct('off', n * 10 + 1, 'ms', commit_ms + (n * 37) % 8000 + 60000), NULL)")
    late = F.expr("IF(n % 400 = 0, named_struct('off', n * 10 + 2, 'ms', commit_ms + 90000000), NULL)")
    return shaped.select(
        "user_id", "value", F.explode(F.array_compact(F.array(first, repeat, late))).alias("d")
    ).select(
        F.lit(model.MAIN_TOPIC).alias("topic"),
        F.expr("CAST(user_id % 12 AS INT)").alias("partition"),
        F.col("d.off").alias("offset"),
        F.concat(F.lit("SKU-"), F.col("user_id")).alias("key"),
        "value",
        F.timestamp_millis(F.col("d.ms")).alias("timestamp"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, "log", sf_dir, lambda: build_change_log(spark, sf_dir))


def consumer_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: offsets the consumer committed, and when: every fifth message, some time after it; one partition falls silent."""
    n = F.floor(F.col("offset") / 10)
    silent = (F.col("partition") == 7) & (F.col("timestamp") >= F.lit("2024-01-20").cast("timestamp"))
    at = F.unix_millis("timestamp") + 20_000 + n % 7 * 60_000
    return change_log(spark, sf_dir).filter((n % 5 == 0) & ~silent).select(
        "topic", "partition", "offset", F.timestamp_millis(at).alias("timestamp")
    )


def counted_offsets(outcomes: DataFrame) -> DataFrame:
    """outcomes over dense offsets of twelve partitions; repeats count an offset again, and some ranges are lost."""
    n = F.floor(F.col("kafka_offset") / 10).cast("bigint")
    offset = F.floor(n / 12).cast("bigint")
    return outcomes.filter(~(offset % 97).isin(5, 6)).select(
        F.lit(model.MAIN_TOPIC).alias("topic"), (n % 12).cast("int").alias("partition"), offset.alias("offset"), "result"
    )


def log_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """first and last offset of each partition of that log."""
    n = F.col("event_id")
    offset = F.floor(n / 12).cast("bigint")
    return table(spark, sf_dir, "events").groupBy((n % 12).cast("int").alias("partition")).agg(
        F.min(offset).alias("first_offset"), F.max(offset).alias("end_offset")
    ).withColumn("topic", F.lit(model.MAIN_TOPIC))


def warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 source table: stock per (part, supplier)."""
    use_utc(spark)
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(
            F.sum("l_quantity").cast("int").alias("available_qty"),
            F.count(F.lit(1)).alias("row_version"),
            F.max("l_shipdate").cast("timestamp").alias("last_updated"),
        )
        .select(
            F.concat(F.lit("SKU-"), F.col("l_partkey")).alias("product_id"),
            F.concat(F.lit("WH-"), F.col("l_suppkey")).alias("warehouse_id"),
            "available_qty",
            F.lit(0).alias("reserved_qty"),
            F.lit("ACTIVE").alias("stock_status"),
            "row_version",
            "last_updated",
            F.col("l_partkey").alias("_p"),
        )
    )


def source_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, "warehouse", sf_dir, lambda: warehouse(spark, sf_dir)).drop("_p")


def website(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 read model: the source table with missing, wrong, newer and older rows."""
    base = stage(spark, "warehouse", sf_dir, lambda: warehouse(spark, sf_dir))
    return base.filter("_p % 101 <> 1").select(
        "product_id",
        "warehouse_id",
        F.expr("available_qty + CASE WHEN _p % 103 = 3 THEN 1 ELSE 0 END").alias("available_qty"),
        "reserved_qty",
        "stock_status",
        F.expr(
            "row_version + CASE WHEN _p % 107 = 5 THEN 1 WHEN _p % 109 = 9 THEN -1 ELSE 0 END"
        ).alias("row_version"),
        F.concat_ws("-", F.lit("seed"), "product_id", "warehouse_id").alias("last_event_id"),
        F.col("last_updated").alias("last_db_commit_ts"),
        (F.col("last_updated") + F.expr("INTERVAL 2 SECONDS")).alias("updated_at"),
    )


def reservations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one reservation per order line."""
    use_utc(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.concat(F.lit("ORD-"), F.col("o_orderkey")).alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.concat(F.lit("SKU-"), F.col("l_partkey")).alias("product_id"),
        F.concat(F.lit("WH-"), F.col("l_suppkey")).alias("warehouse_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'FULFILLED' WHEN 'O' THEN 'OPEN' ELSE 'PENDING' END").alias(
            "reservation_status"
        ),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stock movements, one per event."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("SKU-"), F.col("user_id")).alias("product_id"),
        F.lit("WH-0").alias("warehouse_id"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("moved_at"),
        F.expr(
            """CAST(CASE event_type WHEN 'purchase' THEN -floor(value) WHEN 'view' THEN -3
            WHEN 'signup' THEN floor(value / 2) ELSE 10 END AS BIGINT)"""
        ).alias("delta"),
    )
