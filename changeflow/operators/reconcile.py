"""Source table against read model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.model import KEY

# --- fixed values: usual row cap of one reconciliation run, reason labels -------------------------
MAX_ROWS_PER_RUN = 1000
MISSING_IN_WEBSITE = "missing_in_website"
WEBSITE_BEHIND = "website_behind"
WEBSITE_AHEAD = "website_ahead"
VALUE_MISMATCH = "value_mismatch"


def mismatch_view(warehouse: DataFrame, website: DataFrame) -> DataFrame:
    """Every source row that the read model lacks or holds with another quantity or version.

    One equi-join on the key, unique on both sides; Spark picks the strategy from
    the table sizes. One-sided: rows that only the read model has are not reported.
    """
    w = warehouse.select(
        *KEY,
        F.col("available_qty").alias("warehouse_qty"),
        F.col("row_version").alias("warehouse_version"),
        F.col("last_updated").alias("warehouse_updated_at"),
    )
    s = website.select(
        *KEY,
        F.col("available_qty").alias("website_qty"),
        F.col("row_version").alias("website_version"),
        F.col("updated_at").alias("website_updated_at"),
        F.lit(True).alias("_found"),
    )
    missing = F.col("_found").isNull()
    return (
        w.join(s, KEY, "left")
        .filter(
            missing
            | (F.col("warehouse_qty") != F.col("website_qty"))
            | (F.col("warehouse_version") != F.col("website_version"))
        )
        .select(
            *KEY,
            "warehouse_qty",
            "website_qty",
            "warehouse_version",
            "website_version",
            "warehouse_updated_at",
            "website_updated_at",
            F.when(missing, F.lit(MISSING_IN_WEBSITE))
            .when(F.col("warehouse_version") > F.col("website_version"), F.lit(WEBSITE_BEHIND))
            .when(F.col("warehouse_version") < F.col("website_version"), F.lit(WEBSITE_AHEAD))
            .otherwise(F.lit(VALUE_MISMATCH))
            .alias("reason"),
        )
    )


def reconcile(warehouse: DataFrame, website: DataFrame, limit: int | None = None) -> DataFrame:
    """The report of one run: all mismatches, first keys first.

    With a positive ``limit``, such as MAX_ROWS_PER_RUN, only so many.
    """
    rows = mismatch_view(warehouse, website).select(
        *KEY, "warehouse_qty", "website_qty", "warehouse_version", "website_version"
    ).orderBy(*KEY)
    return rows.limit(limit) if limit is not None and limit > 0 else rows


def mismatch_by_reason(mismatches: DataFrame) -> DataFrame:
    return mismatches.groupBy("reason").agg(F.count(F.lit(1)).alias("mismatches")).orderBy(
        F.desc("mismatches"), "reason"
    )


def replay_window(mismatches: DataFrame, website: DataFrame) -> DataFrame:
    """Commit-time range of the read-model rows that disagree: where a replay has to start and end."""
    return (
        website.select(*KEY, "last_db_commit_ts")
        .join(mismatches.select(*KEY), KEY)
        .agg(F.min("last_db_commit_ts").alias("since"), F.max("last_db_commit_ts").alias("until"))
    )


def mismatch_gauge(mismatches: DataFrame, limit: int | None = None) -> DataFrame:
    """Gauge value of a run and the whole count: the same, unless the run's report had a ``limit``."""
    counted = mismatches.agg(F.count(F.lit(1)).alias("mismatches"))
    gauge = F.col("mismatches") if limit is None else F.least(F.col("mismatches"), F.lit(limit).cast("bigint"))
    return counted.select(gauge.alias("gauge"), "mismatches")


def reconcile_run(warehouse: DataFrame, website: DataFrame, run_at: Column) -> DataFrame:
    """One scheduled run as rows to append to a history: counts per reason stamped with the run time.

    The schedule (at start, then hourly) belongs to whatever submits the job.
    """
    return mismatch_by_reason(mismatch_view(warehouse, website)).select(run_at.alias("run_at"), "reason", "mismatches")


def run_summary(mismatches: DataFrame, run_at: Column, critical: Sequence[str] = ()) -> DataFrame:
    """One run as one row ``(run_at, mismatches, critical_mismatches)``, of zeros where nothing differs.

    ``critical`` lists the products whose mismatches count as critical.
    """
    is_critical = F.col("product_id").isin(list(critical))
    return mismatches.agg(
        F.count(F.lit(1)).alias("mismatches"), F.count_if(is_critical).alias("critical_mismatches")
    ).select(run_at.alias("run_at"), "mismatches", "critical_mismatches")


def dlq_investigate(dead: DataFrame, per_reason: int = 5) -> DataFrame:
    """The first dead letters of every reason, to look at by hand.

    A top-n per group: Spark cuts each partition to n rows per reason before the shuffle.
    """
    first = Window.partitionBy("reason").orderBy("first_failed_at", "original_partition", "original_offset")
    return dead.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= per_reason).drop("_n")
