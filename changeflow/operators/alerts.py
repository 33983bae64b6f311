"""Alert rules on the evaluation grid: a condition, and how long it must hold before it fires."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow import model
from changeflow.operators import metrics as M


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    hold: int
    condition: Column


@dataclass(frozen=True)
class Thresholds:
    """Fixed values of the shipped rules."""

    p95_seconds: float = 3.0
    lag: int = 50_000
    dlq_per_second: float = 10.0
    warnings_per_second: float = 1.0
    mismatches: int = 100


# --- fixed values: window lengths, in seconds ------------------------------------------------------
WINDOWS = {"5m": 300, "15m": 900, "1h": 3600, "6h": 21600}


#: The dead-letter counter has a series for each reason, and a rule holds for each series by itself.
DLQ_SERIES = [f"dlq_{r}" for r in M.REASONS]


def signals(grid: DataFrame, lag: DataFrame, mismatches: Column, step: int = M.STEP) -> DataFrame:
    """Rolling sums the rules read, with two gauges beside them: ``lag`` (``bucket, consumer_lag``
    at every step, see ``worst_lag``) and the mismatch count of the last reconciliation."""
    names = [*M.LE, "latency_count", model.APPLIED, "warnings"]
    wanted = M.per_window(names, WINDOWS) | M.per_window(DLQ_SERIES, {"5m": WINDOWS["5m"]})
    sums = M.rolling(grid, wanted, step)
    return sums.join(lag, "bucket", "left").withColumn("mismatches", mismatches)


def worst_lag(lag: DataFrame) -> DataFrame:
    """(bucket, consumer_lag): that of the topic furthest behind, of ``metrics.lag_series``. A rule on it is active if it is for any topic."""
    return lag.groupBy("bucket").agg(F.max("lag").alias("consumer_lag"))


def oversold(ledger_rows: DataFrame, at: Column, step: int = M.STEP) -> DataFrame:
    """(bucket, clamps, absorbed): movements of each step at which the floor absorbed demand, and how much of it."""
    start = (F.floor(F.unix_millis(at) / F.lit(1000 * step)) * step).cast("bigint")
    clamped = ledger_rows.filter(F.col("absorbed") > 0)
    return clamped.groupBy(start.alias("bucket")).agg(
        F.count(F.lit(1)).alias("clamps"), F.sum("absorbed").cast("bigint").alias("absorbed")
    )


def p95(window: str) -> Column:
    return M.histogram_quantile(0.95, f"_{window}")


def _rate(name: str, window: str) -> Column:
    return F.col(f"{name}_{window}") / F.lit(float(WINDOWS[window]))


def shipped_rules(limits: Thresholds = Thresholds()) -> list[Rule]:
    """The seven rules; only the thresholds are meant to be changed."""
    slow = limits.p95_seconds
    return [
        Rule("InventorySyncLatencySLOBurnFast", "page", 300, (p95("5m") > slow) & (p95("1h") > slow)),
        Rule("InventorySyncLatencySLOBurnSlow", "ticket", 1800, p95("6h") > slow),
        Rule("InventoryConsumerLagHigh", "page", 600, F.col("consumer_lag") > limits.lag),
        Rule("InventoryEventsThroughputZero", "page", 300, _rate(model.APPLIED, "5m") == 0),
        Rule("InventoryDLQSpike", "page", 300, F.greatest(*(_rate(n, "5m") for n in DLQ_SERIES)) > limits.dlq_per_second),
        Rule("InventorySchemaWarningRising", "ticket", 900, _rate("warnings", "15m") > limits.warnings_per_second),
        Rule("InventoryReconciliationMismatchHigh", "page", 600, F.col("mismatches") > limits.mismatches),
    ]


def alert_rules(signal_rows: DataFrame, rules: Sequence[Rule] | None = None, step: int = M.STEP) -> DataFrame:
    """(eval_ts, alert, severity, active, firing) for every rule at every step.

    A rule fires once it has been active at every step of its hold time, so the
    streak is a rolling count over a bounded stretch and needs no whole-history window.
    """
    rules = shipped_rules() if rules is None else rules
    flags = [F.coalesce(r.condition, F.lit(False)).cast("int").alias(f"_a{i}") for i, r in enumerate(rules)]
    counted = M.rolling(
        signal_rows.select("bucket", *flags),
        {f"_held{i}": (f"_a{i}", r.hold + step) for i, r in enumerate(rules)},
        step,
    )
    rows = [
        F.struct(
            F.lit(r.name).alias("alert"),
            F.lit(r.severity).alias("severity"),
            (F.col(f"_a{i}") == 1).alias("active"),
            (F.col(f"_held{i}") == r.hold // step + 1).alias("firing"),
        )
        for i, r in enumerate(rules)
    ]
    return counted.select((F.col("bucket") + step).alias("eval_ts"), F.inline(F.array(*rows)))


def held(rows: DataFrame, conditions: Mapping[str, tuple[Column, int]], step: int = M.STEP) -> DataFrame:
    """Add a flag per (condition, hold in seconds): true at every step of the hold time and now."""
    flags = {f"_is_{n}": F.coalesce(c, F.lit(False)).cast("int") for n, (c, _) in conditions.items()}
    sums = {f"_held_{n}": (f"_is_{n}", hold + step) for n, (_, hold) in conditions.items()}
    counted = M.rolling(rows.select("*", *(c.alias(n) for n, c in flags.items())), sums, step)
    return counted.select(
        *rows.columns, *((F.col(f"_held_{n}") == hold // step + 1).alias(n) for n, (_, hold) in conditions.items())
    )


def latest_run(grid: DataFrame, runs: DataFrame, step: int = M.STEP) -> DataFrame:
    """(bucket, mismatches, critical_mismatches) of the last run (``reconcile.run_summary``) at or before
    each step's evaluation time. Steps before the first run have no row."""
    span = grid.agg(F.min("bucket").alias("start"), F.max("bucket").alias("end"))
    at = F.unix_millis("run_at") / F.lit(1000)
    first = ((F.ceil(at / step) - 1) * step).cast("bigint")  # evaluated at the end of the step
    in_order = Window.orderBy("run_at")  # one row a run
    values = ["mismatches", "critical_mismatches"]
    runs = runs.select(*values, first.alias("from"), (F.lead(first).over(in_order) - step).alias("to"))
    runs = runs.withColumn("_one", F.lit(1)).join(F.broadcast(span.withColumn("_one", F.lit(1))), "_one")  # one row
    lasting = runs.select(*values, F.greatest("from", "start").alias("lo"), F.least(F.coalesce("to", "end"), "end").alias("hi"))
    return M.steps_of(lasting, step).select("bucket", *values)


def backlog(outcomes: DataFrame, commit_seconds: Column, log_seconds: Column, step: int = M.STEP) -> DataFrame:
    """Events committed at the source but not yet logged, at the end of every step: what capture is behind by.

    The consumer's lag is ``metrics.lag_series``.

    Each event is +1 at its commit and -1 at its arrival. The grid covers log
    time, which producers don't control; a commit outside of it counts in the
    first or last step, and ``outside`` says how many of a step's did.

    The running sum is taken over days first and within each day then.
    """

    def start(seconds: Column) -> Column:
        return (F.floor(seconds / step) * step).cast("bigint")

    moves = outcomes.filter(F.col("commit_ts").isNotNull()).select(
        start(commit_seconds).alias("commit"), start(log_seconds).alias("log"), F.lit(1).alias("one")
    )
    span = moves.agg(F.min("log").alias("lo"), F.max("log").alias("hi")).withColumn("one", F.lit(1))
    moves = moves.join(F.broadcast(span), "one")  # one row
    inside = F.greatest(F.least("commit", "hi"), "lo")
    changes = (
        moves.select(
            F.inline(
                F.array(
                    F.struct(inside.alias("bucket"), F.lit(1).alias("change"), (inside != F.col("commit")).cast("int").alias("outside")),
                    F.struct(F.col("log").alias("bucket"), F.lit(-1).alias("change"), F.lit(0).alias("outside")),
                )
            )
        )
        .groupBy("bucket")
        .agg(F.sum("change").alias("change"), F.sum("outside").alias("outside"))
    )
    steps = M.fill_grid(changes, step).withColumn("_day", F.floor(F.col("bucket") / M.SLICE_SECONDS).cast("bigint"))
    so_far = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)  # one row a day
    days = steps.groupBy("_day").agg(F.sum("change").alias("_sum")).select("_day", F.coalesce(F.sum("_sum").over(so_far), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_day").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return steps.join(days, "_day").select(
        "bucket", (F.col("_before") + F.sum("change").over(within)).alias("consumer_lag"), "outside"
    )
