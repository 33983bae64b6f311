"""Queries of the read model, the reservations and the source table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.model import KEY


def by_product(state: DataFrame, product_id: str, warehouse_id: str | None = None) -> DataFrame:
    """Point lookup; both predicates reach the scan."""
    found = state.filter(F.col("product_id") == product_id)
    return found if warehouse_id is None else found.filter(F.col("warehouse_id") == warehouse_id)


def by_status(state: DataFrame, status: str) -> DataFrame:
    return state.filter(F.col("stock_status") == status)


def status_counts(state: DataFrame) -> DataFrame:
    return state.groupBy("stock_status").agg(F.count(F.lit(1)).alias("items"))


def _newest(df: DataFrame, column: str, n: int) -> DataFrame:
    # The key makes the order total; sort plus limit runs as a top-n per partition.
    return df.orderBy(F.desc(column), *KEY).limit(n)


def recently_updated(state: DataFrame, n: int) -> DataFrame:
    return _newest(state, "updated_at", n)


def by_commit_recency(state: DataFrame, n: int) -> DataFrame:
    return _newest(state, "last_db_commit_ts", n)


def source_recency(warehouse: DataFrame, n: int) -> DataFrame:
    return _newest(warehouse, "last_updated", n)


def reservations_for_order(reservations: DataFrame, order_id: str) -> DataFrame:
    return reservations.filter(F.col("order_id") == order_id)


def reservations_for_sku(reservations: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` reservations per (product, warehouse), with their rank.

    A rank limit is pushed below the shuffle, so a hot SKU arrives as n rows per partition.
    """
    newest = Window.partitionBy(*KEY).orderBy(
        F.desc("created_at"), "order_id", "line_number", F.desc("quantity"), "reservation_status"
    )
    return reservations.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= n)
