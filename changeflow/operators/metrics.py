"""Counters, histogram, quantiles and rates over the outcome table.

All series come from one aggregation of the outcomes into 15-second rows
(``bucketize``); everything with a time range works on those rows, whose number
depends on the length of time covered and not on the number of events.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow import model

# --- fixed values: scrape step and latency bucket bounds, in seconds ----------------------------
STEP = 15
BOUNDS = [0.1, 0.25, 0.5, 1.0, 2.0, 3.0, 5.0, 10.0, 30.0]

# Time slice of grids and rolling sums: a slice and the stretch before it are one task's work.
SLICE_SECONDS = 24 * 3600

RESULTS = [model.APPLIED, model.SKIPPED, model.REJECTED, model.DLQ]
REASONS = [model.DECODE_ERROR, model.MISSING_REQUIRED, model.SCHEMA_BREAKING, model.PROJECTION_ERROR, model.NO_MAPPING]

LE = [f"le_{i}" for i in range(len(BOUNDS))]
LATENCY = [*LE, "latency_count", "latency_sum_ms"]
COUNTERS = [model.RECEIVED, *RESULTS, *[f"dlq_{r}" for r in REASONS], "warnings"]
SERIES = [*COUNTERS, *LATENCY]


def series_aggregates() -> list[Column]:
    """Aggregates of every series; each is a sum or count, so partials combine map-side."""
    text = [
        f"count(1) AS {model.RECEIVED}",
        *[f"count_if(result = '{r}') AS {r}" for r in RESULTS],
        *[f"count_if(dlq_reason = '{r}') AS dlq_{r}" for r in REASONS],
        f"count_if(schema_decision = '{model.CONDITIONAL}') AS warnings",
        *[f"count_if(latency_ms <= {int(bound * 1000)}) AS {name}" for bound, name in zip(BOUNDS, LE)],
        "count(latency_ms) AS latency_count",
        "CAST(coalesce(sum(latency_ms), 0) AS BIGINT) AS latency_sum_ms",
    ]
    return [F.expr(t) for t in text]


def outcome_counts(outcomes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counter per result; ``received`` counts every message in the same counter."""
    wide = outcomes.groupBy(*by).agg(
        F.count(F.lit(1)).alias(model.RECEIVED), *[F.count_if(F.col("result") == r).alias(r) for r in RESULTS]
    )
    return wide.unpivot(list(by), [model.RECEIVED, *RESULTS], "result", "events").filter("events > 0")


def latency_histogram(outcomes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cumulative buckets as rows ``(le, events)`` with ``+Inf``, plus sum and count."""
    wide = outcomes.groupBy(*by).agg(*series_aggregates()).select(*by, *LATENCY)
    labels = [str(b) for b in BOUNDS]
    pairs = F.array(
        *[F.struct(F.lit(label).alias("le"), F.col(name).alias("events")) for label, name in zip(labels, LE)],
        F.struct(F.lit("+Inf").alias("le"), F.col("latency_count").alias("events")),
    )
    return wide.select(
        *by,
        F.inline(pairs),
        (F.col("latency_sum_ms") / F.lit(1000.0)).alias("latency_sum"),
        "latency_count",
    )


def histogram_quantile(q: float, suffix: str = "") -> Column:
    """Quantile from the cumulative counts ``le_<i><suffix>``: linear inside a bucket, the first bucket
    starting at zero; above the last finite bound the answer is that bound; no events, no answer."""
    total = f"latency_count{suffix}"
    rank = f"({float(q)!r}D * {total})"
    arms, low, below = [], 0.0, "0"
    for bound, name in zip(BOUNDS, LE):
        count = f"{name}{suffix}"
        arms.append(
            f"WHEN {count} >= {rank} THEN {low!r}D + {bound - low!r}D * try_divide({rank} - {below}, {count} - {below})"
        )
        low, below = bound, count
    return F.expr(f"CASE WHEN {total} > 0 THEN CASE {' '.join(arms)} ELSE {BOUNDS[-1]!r}D END END")


def latency_quantiles(outcomes: DataFrame, quantiles: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    wide = outcomes.agg(*series_aggregates())
    return wide.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(q).alias("q"), histogram_quantile(q).alias("latency_seconds")) for q in quantiles]
            )
        )
    )


def log_seconds() -> Column:
    return F.floor(F.unix_millis("log_ts") / F.lit(1000)).cast("bigint")


def bucketize(outcomes: DataFrame, seconds: Column | None = None, step: int = STEP) -> DataFrame:
    """One row per ``step`` seconds that saw events, with every series. ``bucket`` = start, in epoch seconds."""
    seconds = log_seconds() if seconds is None else seconds
    start = (F.floor(seconds / F.lit(step)) * F.lit(step)).cast("bigint")
    return outcomes.groupBy(start.alias("bucket")).agg(*series_aggregates())


def rollup(buckets: DataFrame, width: int) -> DataFrame:
    """Coarser rows from finer ones: every series is a count or sum, so they add up. ``bucket`` = start of the row."""
    start = (F.floor(F.col("bucket") / width) * width).cast("bigint")
    names = [c for c in buckets.columns if c != "bucket"]
    return buckets.groupBy(start.alias("bucket")).agg(*[F.sum(n).cast("bigint").alias(n) for n in names])


def steps_of(span: DataFrame, step: int = STEP) -> DataFrame:
    """Every step from ``lo`` to ``hi`` for each row of ``span``, whose other columns stay.

    Days are expanded first, and steps within each day, so no row holds more
    than a day's steps or the list of days.
    """
    keep = [c for c in span.columns if c not in ("lo", "hi")]
    day = F.lit(SLICE_SECONDS // step * step).cast("bigint")
    days = span.filter("lo <= hi").select(*keep, "hi", F.explode(F.sequence("lo", "hi", day)).alias("from"))
    last = F.least(F.col("hi"), F.col("from") + day - step)
    return days.select(*keep, F.explode(F.sequence("from", last, F.lit(step).cast("bigint"))).alias("bucket"))


def fill_grid(buckets: DataFrame, step: int = STEP) -> DataFrame:
    """Every step from the first to the last bucket, absent ones as zeros."""
    names = [c for c in buckets.columns if c != "bucket"]
    grid = steps_of(buckets.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi")), step)
    return grid.join(buckets, "bucket", "left").select(
        "bucket", *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in names]
    )


def rolling(
    grid: DataFrame, sums: Mapping[str, tuple[str, int]], step: int = STEP
) -> DataFrame:
    """Add rolling sums to a gapless grid: ``sums`` maps an output name to (column, window in seconds).

    A window's sum is the running sum now minus the running sum one window ago,
    so its cost does not depend on its length. Time is cut into slices; a row
    also goes to the next slices that still look back on it, so slices are
    summed independently of each other.
    """
    longest = max(w for _, w in sums.values())
    width = max(SLICE_SECONDS, longest)
    here = F.floor(F.col("bucket") / width).cast("bigint")
    last = F.floor((F.col("bucket") + (longest - step)) / width).cast("bigint")
    spread = grid.withColumn("_home", here).withColumn("_slice", F.explode(F.sequence(here, last)))
    order = Window.partitionBy("_slice").orderBy("bucket")
    names = sorted({name for name, _ in sums.values()})
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    summed = spread.select("*", *[F.sum(n).over(so_far).alias(f"_sum_{n}") for n in names])
    ago = {
        (n, w): F.lag(f"_sum_{n}", w // step).over(order).alias(f"_ago_{n}_{w}") for n, w in set(sums.values())
    }
    looked_back = summed.select("*", *ago.values())
    return looked_back.filter(F.col("_slice") == F.col("_home")).select(
        *grid.columns,
        *[
            (F.col(f"_sum_{n}") - F.coalesce(f"_ago_{n}_{w}", F.lit(0))).alias(out)
            for out, (n, w) in sums.items()
        ],
    )


def per_window(names: Sequence[str], windows: Mapping[str, int]) -> dict[str, tuple[str, int]]:
    """``<name>_<label>`` for every name and window, as ``rolling`` takes it."""
    return {f"{n}_{label}": (n, w) for label, w in windows.items() for n in names}


def event_rate(grid: DataFrame, name: str = model.APPLIED, window: int = 60, step: int = STEP) -> DataFrame:
    """Events per second of one counter over the last ``window`` seconds, at every step."""
    return rolling(grid, {f"{name}_w": (name, window)}, step).select(
        (F.col("bucket") + step).alias("eval_ts"), (F.col(f"{name}_w") / F.lit(float(window))).alias("rate")
    )


def dlq_by_reason(grid: DataFrame, window: int = 3600, step: int = STEP) -> DataFrame:
    """Dead letters of the last ``window`` seconds per reason, at every step that has any."""
    sums = rolling(grid, {r: (f"dlq_{r}", window) for r in REASONS}, step)
    wide = sums.select((F.col("bucket") + step).alias("eval_ts"), *REASONS)
    return wide.unpivot(["eval_ts"], REASONS, "reason", "events").filter("events > 0")


def schema_warning_count(grid: DataFrame, window: int = 3600, step: int = STEP) -> DataFrame:
    """Conditional verdicts of the last ``window`` seconds, at every step that has any; repeats that were skipped later count too."""
    sums = rolling(grid, {"warnings_w": ("warnings", window)}, step)
    return sums.select((F.col("bucket") + step).alias("eval_ts"), F.col("warnings_w").alias("warnings")).filter("warnings > 0")


def consumer_lag(log: DataFrame, processed: DataFrame) -> DataFrame:
    """Offsets not yet processed, per topic and partition. An untouched partition lags by its whole log."""
    end = log.groupBy("topic", "partition").agg(
        F.max("offset").alias("end_offset"), F.min("offset").alias("first_offset")
    )
    done = processed.groupBy("topic", "partition").agg(F.max("offset").alias("committed_offset"))
    return end.join(done, ["topic", "partition"], "left").select(
        "topic",
        "partition",
        "end_offset",
        "committed_offset",
        (F.col("end_offset") - F.coalesce("committed_offset", F.col("first_offset") - 1)).alias("lag"),
    )


def _step_of(at: Column, step: int) -> Column:
    return (F.floor(F.unix_millis(at) / F.lit(1000 * step)) * step).cast("bigint")


def _by_day() -> Column:
    return F.floor(F.col("bucket") / SLICE_SECONDS).cast("bigint")


def _so_far(rows: DataFrame, by: Sequence[str], values: Mapping[str, tuple[str, str]], current: bool) -> DataFrame:
    """``rows`` (with ``bucket``) and running sums or maxima: ``values`` maps a name to ("sum" or "max", column).

    Days are summed up first and carried over the days; the rows of one day are
    one task's work, however long the history. Null where nothing came before.
    """
    how = {"sum": F.sum, "max": F.max}
    rows = rows.withColumn("_day", _by_day())
    earlier = Window.partitionBy(*by).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = rows.groupBy(*by, "_day").agg(*[how[h](c).alias(n) for n, (h, c) in values.items()])
    days = days.select(*by, "_day", *[how[h](n).over(earlier).alias(f"_carry_{n}") for n, (h, _) in values.items()])
    day = Window.partitionBy(*by, "_day").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0 if current else -1)

    def both(n: str, h: str, c: str) -> Column:
        carried, here = F.col(f"_carry_{n}"), how[h](c).over(day)
        return F.coalesce(carried + here, carried, here) if h == "sum" else F.greatest(carried, here)

    keep = [c for c in rows.columns if c != "_day"]
    return rows.join(days, [*by, "_day"]).select(*keep, *[both(n, h, c).alias(n) for n, (h, c) in values.items()])


def lag_series(log: DataFrame, commits: DataFrame, grid: DataFrame, step: int = STEP) -> DataFrame:
    """(topic, bucket, lag): offsets in the log that the consumer hasn't committed, at the end of every step of ``grid``.

    ``log`` has topic, partition, offset and timestamp of every message, ``commits``
    the same of every offset the consumer committed. A partition keeps its last end
    and its last committed offset until it has newer ones, so one that falls silent
    keeps its lag; one that was never committed lags by its whole log. What lies
    before the grid counts in its first step.

    Only changes of a partition's lag are kept and summed by topic; their running
    sum is the topic's lag.
    """
    part = ["topic", "partition"]
    offset, no_offset = F.col("offset"), F.lit(None).cast("bigint")
    ends = log.groupBy(*part, _step_of(F.col("timestamp"), step).alias("bucket")).agg(F.max(offset).alias("end"), F.min(offset).alias("first"))
    done = commits.groupBy(*part, _step_of(F.col("timestamp"), step).alias("bucket")).agg(F.max(offset).alias("done"))
    seen = ends.withColumn("done", no_offset).unionByName(done.withColumns({"end": no_offset, "first": no_offset}))
    seen = seen.groupBy(*part, "bucket").agg(F.max("end").alias("end"), F.max("done").alias("done"))
    first = ends.groupBy(*part).agg((F.min("first") - 1).alias("start"))
    before = _so_far(seen, part, {"end_before": ("max", "end"), "done_before": ("max", "done")}, current=False)

    def grown(name: str) -> Column:
        old = F.coalesce(f"{name}_before", F.col("start"))
        return F.greatest(F.col(name), old) - old

    # Commits of a partition whose messages aren't in the log have no lag to take from.
    moves = before.join(first, part).select("topic", "bucket", (F.coalesce(grown("end"), F.lit(0)) - F.coalesce(grown("done"), F.lit(0))).alias("change"))
    span = grid.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi")).withColumn("one", F.lit(1))
    moves = moves.withColumn("one", F.lit(1)).join(F.broadcast(span), "one")  # one row
    changes = moves.filter("bucket <= hi").groupBy("topic", F.greatest("bucket", "lo").alias("bucket")).agg(F.sum("change").alias("change"))
    topics = moves.groupBy("topic").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    steps = steps_of(topics, step).join(changes, ["topic", "bucket"], "left").fillna(0, ["change"])
    return _so_far(steps, ["topic"], {"lag": ("sum", "change")}, current=True).select("topic", "bucket", "lag")


def topic_lag(lag: DataFrame) -> DataFrame:
    return lag.groupBy("topic").agg(F.sum("lag").alias("lag"))


def success_rate(grid: DataFrame, window: int = 300, step: int = STEP) -> DataFrame:
    """Two readings at every step.

    ``panel_success_rate`` divides by all series of the counter, received
    included, and by no less than one event per second, as the dashboard does.
    ``slo_success_rate`` is applied over received (null without events).
    """
    names = [model.RECEIVED, *RESULTS]
    sums = rolling(grid, per_window(names, {"w": window}), step)
    every = sum((F.col(f"{n}_w") for n in names[1:]), F.col(f"{names[0]}_w"))
    seconds = F.lit(float(window))
    applied = F.col(f"{model.APPLIED}_w")
    return sums.select(
        (F.col("bucket") + step).alias("eval_ts"),
        ((applied / seconds) / F.greatest(every / seconds, F.lit(1.0))).alias("panel_success_rate"),
        F.try_divide(applied, F.col(f"{model.RECEIVED}_w")).alias("slo_success_rate"),
    )


def threshold_band(value: Column, yellow: float | None, red: float) -> Column:
    """Colour step of a panel; a missing value has no colour."""
    band = F.when(value.isNull(), F.lit(None).cast("string")).when(value >= red, F.lit("red"))
    if yellow is not None:
        band = band.when(value >= yellow, F.lit("yellow"))
    return band.otherwise(F.lit("green"))


def bench_summary(runs: DataFrame) -> DataFrame:
    """Per scenario: runs, mean and population deviation of the rate, mean and total events sent.

    A scenario without any rate is left out; a record without a scenario counts as ``unknown``.
    """
    return (
        runs.groupBy(F.coalesce(F.col("scenario"), F.lit("unknown")).alias("scenario"))
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.round(F.avg("effective_rate"), 2).alias("rate_mean"),
            F.round(F.stddev_pop("effective_rate"), 2).alias("rate_stdev"),
            F.round(F.avg("events_sent"), 2).alias("events_sent_mean"),
            F.sum("events_sent").alias("events_sent_total"),
        )
        .filter(F.col("rate_mean").isNotNull())
    )
