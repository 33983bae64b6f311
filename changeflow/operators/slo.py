"""Service levels, error budget, burn rates and the escalation matrix."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow import model
from changeflow.operators import metrics as M

# --- fixed values: objectives (name, target, direction) -------------------------------------------
SUCCESS_TARGET = 0.9995
OBJECTIVES = [
    ("freshness_p95", 3.0, "max"),
    ("freshness_p99", 5.0, "max"),
    ("successful_processing", SUCCESS_TARGET, "min"),
    ("mismatch_rate", 0.001, "max"),
    ("sla_freshness_p95", 5.0, "max"),
    ("sla_freshness_p99", 10.0, "max"),
]
MISMATCH_BASE = 1000

# --- fixed values: burn alerts (long window s, short window s, factor, severity) ---------------------
BURN_PAIRS = [
    ("fast", 3600, 300, 14.4, "page"),
    ("medium", 6 * 3600, 1800, 6.0, "page"),
    ("slow", 24 * 3600, 2 * 3600, 3.0, "ticket"),
    ("drip", 72 * 3600, 6 * 3600, 1.0, "ticket"),
]

# --- fixed value: budget window ------------------------------------------------------------------------
BUDGET_DAYS = 28
DAY = 24 * 3600


def _objective_rows(values: Mapping[str, Column]) -> Column:
    rows = [
        F.struct(
            F.lit(name).alias("slo"),
            values[name].cast("double").alias("value"),
            F.lit(target).alias("target"),
            (values[name] <= target if way == "max" else values[name] >= target).alias("met"),
        )
        for name, target, way in OBJECTIVES
    ]
    return F.inline(F.array(*rows))


def _objectives(mismatches: Column, suffix: str = "") -> dict[str, Column]:
    p95, p99 = M.histogram_quantile(0.95, suffix), M.histogram_quantile(0.99, suffix)
    return {
        "freshness_p95": p95,
        "freshness_p99": p99,
        "successful_processing": F.try_divide(F.col(model.APPLIED + suffix), F.col(model.RECEIVED + suffix)),
        "mismatch_rate": mismatches / F.lit(float(MISMATCH_BASE)),
        "sla_freshness_p95": p95,
        "sla_freshness_p99": p99,
    }


def slo_report(outcomes: DataFrame, run: DataFrame) -> DataFrame:
    """(slo, value, target, met), from one aggregation of the outcomes and the gauge of the last run (one row, ``gauge``)."""
    wide = outcomes.agg(*M.series_aggregates()).join(F.broadcast(run.select("gauge")), F.lit(True), "left")  # one row each
    return wide.select(_objective_rows(_objectives(F.col("gauge"))))


def over_days(days: DataFrame, window_days: int = BUDGET_DAYS) -> DataFrame:
    """At the end of every day the series summed over the trailing ``window_days``, as ``<name>_w``, beside the day's own.

    ``days`` are rows of a day (``metrics.rollup``), gapless (``metrics.fill_grid``): a
    long window is a few dozen rows, not the finer ones it is made of.
    """
    names = [model.RECEIVED, model.APPLIED, *M.LE, "latency_count"]
    return M.rolling(days, M.per_window(names, {"w": window_days * DAY}), DAY)


def daily_objectives(days: DataFrame, runs: DataFrame, window_days: int = BUDGET_DAYS) -> DataFrame:
    """(eval_ts, slo, value, target, met) at the end of every day: freshness and success over the trailing
    window, mismatches of the day's last reconciliation (``reconcile.run_summary``; null on days without one)."""
    day = (F.floor(F.unix_seconds("run_at") / DAY) * DAY).cast("bigint")
    last = runs.groupBy(day.alias("bucket")).agg(F.max_by("mismatches", "run_at").alias("_mismatches"))
    rows = over_days(days, window_days).join(last, "bucket", "left")
    return rows.select((F.col("bucket") + DAY).alias("eval_ts"), _objective_rows(_objectives(F.col("_mismatches"), "_w")))


def daily_budget(days: DataFrame, target: float = SUCCESS_TARGET, window_days: int = BUDGET_DAYS) -> DataFrame:
    """At the end of every day: the day's and the trailing window's allowed and consumed failures, and what is left."""

    def budget(suffix: str, label: str) -> list[Column]:
        received, applied = F.col(model.RECEIVED + suffix), F.col(model.APPLIED + suffix)
        allowed, consumed = budget_events(received, target), received - applied
        return [
            received.alias(f"received_{label}"),
            F.round(allowed, 4).alias(f"allowed_{label}"),
            consumed.alias(f"consumed_{label}"),
            F.round(allowed - consumed, 4).alias(f"remaining_{label}"),
        ]

    return over_days(days, window_days).select((F.col("bucket") + DAY).alias("eval_ts"), *budget("", "day"), *budget("_w", "window"))


def budget_events(volume: Column, target: float = SUCCESS_TARGET) -> Column:
    """Events of a volume that may fail."""
    return volume * F.lit(1.0 - target)


def error_budget(outcomes: DataFrame, target: float = SUCCESS_TARGET, days: float = BUDGET_DAYS) -> DataFrame:
    """Allowed, consumed and remaining failures of the events seen, and the budget of a day and of ``days`` at their mean volume."""
    seen = outcomes.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("result") == model.APPLIED).alias("applied"),
        F.count_distinct(F.floor(M.log_seconds() / DAY)).alias("_days"),
    )
    allowed = budget_events(F.col("received"), target)
    consumed = F.col("received") - F.col("applied")
    a_day = F.try_divide(allowed, F.col("_days"))
    return seen.select(
        "received",
        F.round(allowed, 4).alias("allowed"),
        consumed.alias("consumed"),
        F.round(allowed - consumed, 4).alias("remaining"),
        F.round(a_day, 4).alias("allowed_per_day"),
        F.round(a_day * F.lit(float(days)), 4).alias("allowed_per_window"),
    )


def burn_rate(
    grid: DataFrame,
    target: float = SUCCESS_TARGET,
    pairs=BURN_PAIRS,
    step: int = M.STEP,
) -> DataFrame:
    """Burn factor over the long and short window of every pair, at every step; fires when both exceed."""
    windows = {}
    for name, long, short, _, _ in pairs:
        windows[f"{name}_long"], windows[f"{name}_short"] = long, short
    sums = M.rolling(grid, M.per_window([model.RECEIVED, model.APPLIED], windows), step)

    def burn(label: str) -> Column:
        received, applied = F.col(f"{model.RECEIVED}_{label}"), F.col(f"{model.APPLIED}_{label}")
        return F.coalesce(F.try_divide(received - applied, received) / F.lit(1.0 - target), F.lit(0.0))

    rows = [
        F.struct(
            F.lit(name).alias("pair"),
            F.lit(severity).alias("severity"),
            burn(f"{name}_long").alias("long_burn"),
            burn(f"{name}_short").alias("short_burn"),
            ((burn(f"{name}_long") > factor) & (burn(f"{name}_short") > factor)).alias("firing"),
        )
        for name, _, _, factor, severity in pairs
    ]
    return sums.select((F.col("bucket") + step).alias("eval_ts"), F.inline(F.array(*rows)))


def severity_triage(
    halted: Column,
    critical_mismatch: Column,
    latency_high: Column,
    dlq_last_5m: Column,
    lag_high: Column,
    schema_warnings: Column,
    burn: Column,
    overselling: Column | None = None,
    dlq_limit: int = 50,
    burn_limit: float = 3.0,
) -> Column:
    """Escalation level of a set of signals; null when nothing calls for one."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(yes(halted) | yes(critical_mismatch) | yes(F.lit(False) if overselling is None else overselling), F.lit("SEV-1"))
        .when(yes(latency_high) | yes(dlq_last_5m > dlq_limit) | yes(lag_high), F.lit("SEV-2"))
        .when(yes(schema_warnings > 0) | yes(burn > burn_limit), F.lit("SEV-3"))
    )
