"""The kernel: order, deduplicate and version-check gated events against a state.

``event_outcomes`` labels every event; ``versioned_upsert`` gives the next state.
Both are set-based and take the state (and the marks of applied ids) before the
first event, so any split of a log into batches gives the same answer.

One window labels all events whose ids denote one (key, version). Ids that are
used again for something else make labels depend on each other: a skipped event
raises no version, so a later event with a lower version may apply. Keys with
such ids are found by the same window and settled in rounds.

Pass events that are already materialised (a staged table or a persisted batch):
the kernel reads them more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow import model
from changeflow.operators import blocks
from changeflow.session import written

KEY = model.KEY
_ORDER = ["kafka_offset", "kafka_partition"]
# The message text and its images stay in the audit history; only dead letters carry them on.
_BULKY = ["value", "source", "before", "after"]
# Rows that stand for the state and for carried marks sort before every event.
_SEED_OFFSET = -(2**62)
_SEED_STATE, _SEED_MARK = "state", "mark"
#: What an applied id is remembered for: the id and its key, or the id alone.
ID_AND_KEY, ID = "id_and_key", "id"


def _seeds(state: DataFrame | None, marks: DataFrame | None) -> list[DataFrame]:
    """State rows and marks in the shape of events, so one shuffle brings all three together."""
    out = []
    if state is not None:
        # An id of its own keeps state rows from becoming one large group of ids.
        no_event = F.concat_ws("\x00", F.lit(_SEED_STATE), *KEY)
        out.append(state.select(*KEY, no_event.alias("event_id"), "row_version", F.lit(_SEED_STATE).alias("_seed")))
    if marks is not None:
        out.append(marks.select(*KEY, "event_id", F.col("marked_at").alias("log_ts"), F.lit(_SEED_MARK).alias("_seed")))
    return [s.withColumn("kafka_offset", F.lit(_SEED_OFFSET).cast("bigint")) for s in out]


def _with_seeds(events: DataFrame, seeds: list[DataFrame]) -> DataFrame:
    rows = events.withColumn("_seed", F.lit(None).cast("string"))
    for s in seeds:
        rows = rows.unionByName(s, allowMissingColumns=True)
    return rows


def _is_candidate(previous: Column) -> Column:
    """Insert when the key is new, update only on a strictly greater version."""
    return F.col("_seed").isNull() & (previous.isNull() | (F.col("row_version") > previous))


def _is_live(ttl_seconds: int) -> Column:
    age = F.unix_micros("log_ts") - F.unix_micros("_marked_at")
    return F.col("_marked_at").isNotNull() & (age < F.lit(ttl_seconds * 1_000_000))


def _before(*keys: str):
    return Window.partitionBy(*keys).orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1)


def _mark_scope(dedupe: str) -> list[str]:
    if dedupe not in (ID_AND_KEY, ID):
        raise ValueError(f"unknown dedupe {dedupe!r}")
    return [*KEY, "event_id"] if dedupe == ID_AND_KEY else ["event_id"]


def _ordinary(rows: DataFrame, version: Column, mark: Column, scope: list[str]) -> DataFrame:
    """Candidates and earlier marks; every key's rows in one task.

    ``version`` is null where a row doesn't raise its key's version, ``mark`` where it marks nothing.
    """
    ordered = rows.withColumn("_previous", F.max(version).over(_before(*KEY)))
    flagged = ordered.withColumn("_candidate", _is_candidate(F.col("_previous"))).drop("_previous")
    return flagged.withColumn("_marked_at", F.max(mark).over(_before(*scope)))


def _blockwise(rows: DataFrame, version: Column, mark: Column, scope: list[str], rows_per_block: int) -> DataFrame:
    """The same for keys too large for one task: cut by offset, carry between blocks."""
    cut = blocks.with_blocks(rows, "kafka_offset", rows_per_block)
    block = blocks.BLOCK
    versions = blocks.inherited(cut, KEY, {"_carried": ("max", version)})
    local = cut.join(versions, [*KEY, block], "left").withColumn(
        "_previous", F.greatest("_carried", F.max(version).over(_before(*KEY, block)))
    )
    flagged = local.withColumn("_candidate", _is_candidate(F.col("_previous"))).drop("_carried", "_previous")
    # Copies of one event may themselves be a large group, so they are cut the same way.
    marked = blocks.inherited(flagged, scope, {"_carried_mark": ("max", mark)})
    return (
        flagged.join(marked, [*scope, block], "left")
        .withColumn("_marked_at", F.greatest("_carried_mark", F.max(mark).over(_before(*scope, block))))
        .drop("_carried_mark", block)
    )


def _judged(rows: DataFrame, ttl_seconds: int) -> DataFrame:
    live = _is_live(ttl_seconds)
    return rows.withColumns({"_skipped": live & F.col("_seed").isNull(), "_applied": F.col("_candidate") & ~live})


def labelled(
    passing: DataFrame,
    seeds: list[DataFrame],
    ttl_seconds: int = model.MARK_TTL_SECONDS,
    hot: tuple[DataFrame | None, int] = (None, blocks.HOT_ROWS),
) -> DataFrame:
    """Passing events and seeds with _applied, _skipped and _open, by one window over each key.

    It takes every event to raise its key's version, which is true as long as no
    event with a newer version is skipped. ``_open`` tells keys where one is: up to
    its first such event a key's labels are right.
    """
    rows = _with_seeds(passing, seeds)
    version = F.col("row_version")
    mark = F.when(F.col("_candidate") | (F.col("_seed") == _SEED_MARK), F.col("log_ts"))
    scope = _mark_scope(ID_AND_KEY)
    clash = F.col("_candidate") & F.col("_skipped")

    def by_key(part: DataFrame) -> DataFrame:
        judged = _judged(_ordinary(part, version, mark, scope), ttl_seconds)
        return judged.withColumn("_open", F.coalesce(F.max(clash).over(Window.partitionBy(*KEY)), F.lit(False)))

    listed, limit = hot
    if listed is None:
        return by_key(rows).drop("_candidate", "_marked_at")
    cold_rows, hot_part = blocks.split_hot(rows, KEY, listed)
    judged = _judged(_blockwise(hot_part, version, mark, scope, limit), ttl_seconds)
    # At most as many rows as the list of hot keys.
    clashing = judged.filter(clash).select(*KEY, F.lit(True).alias("_clash")).distinct()
    judged = judged.join(F.broadcast(clashing), KEY, "left").withColumn("_open", F.coalesce("_clash", F.lit(False))).drop("_clash")
    return by_key(cold_rows).unionByName(judged).drop("_candidate", "_marked_at")


def _open_by_id(rows: DataFrame) -> DataFrame:
    """``rows`` with _open for keys that share an id with another key, or use one for two versions.

    A mark says nothing of the version it was made for, so its id counts as used for another one.
    """
    what = F.struct(*KEY, F.coalesce("row_version", F.lit(-1).cast("bigint")))
    ids = rows.filter("event_id IS NOT NULL").groupBy("event_id").agg(F.min(what).alias("lo"), F.max(what).alias("hi"))
    keys = rows.join(ids.filter("lo <> hi").select("event_id"), "event_id", "left_semi").select(*KEY).distinct()
    return rows.drop("_open").join(keys.withColumn("_open", F.lit(True)), KEY, "left").fillna(False, ["_open"])


def _settled(rows: DataFrame, ttl_seconds: int, dedupe: str, hot: tuple[DataFrame | None, int]) -> DataFrame:
    """Open keys' rows with the labels that one event after the other would get.

    A label depends on labels of earlier rows only. Each round computes all labels
    anew from the last round's; what depends on right labels only comes out right,
    so at the latest the n-th round has the first n rows of every key right, and
    labels that a round leaves as they were are the answer. Independent clashes
    are settled in the same round: the number of rounds is the length of the
    longest chain of labels that overturn one another. Where ids are remembered for
    their key, keys don't depend on each other, so a key whose labels a round leaves
    as they were is settled, and later rounds read and write the other keys only.
    """
    scope = _mark_scope(dedupe)
    counts = F.col("_applied") | F.col("_seed").isNotNull()
    version = F.when(counts, F.col("row_version"))
    mark = F.when(F.col("_applied") | (F.col("_seed") == _SEED_MARK), F.col("log_ts"))
    listed, limit = hot
    moved = F.coalesce(F.col("_was") != F.struct("_applied", "_skipped"), F.lit(False))

    def by_key(part: DataFrame) -> DataFrame:
        judged = _judged(_ordinary(part, version, mark, scope), ttl_seconds)
        return judged.withColumn("_moved", F.max(moved).over(Window.partitionBy(*KEY)))

    rows, settled = written(rows, "open"), None
    while True:
        before = rows.withColumn("_was", F.struct("_applied", "_skipped"))
        if dedupe == ID:  # an id joins keys, so all go on until none moves; it may be on hot keys and others
            judged = _ordinary(before, version, mark, scope) if listed is None else _blockwise(before, version, mark, scope, limit)
            judged = _judged(judged, ttl_seconds).withColumn("_moved", moved)
        elif listed is None:
            judged = by_key(before)
        else:
            cold_rows, hot_part = blocks.split_hot(before, KEY, listed)
            judged = _judged(_blockwise(hot_part, version, mark, scope, limit), ttl_seconds)
            # At most as many rows as the list of hot keys.
            moving = judged.filter(moved).select(*KEY, F.lit(True).alias("_moved")).distinct()
            judged = by_key(cold_rows).unionByName(judged.join(F.broadcast(moving), KEY, "left").fillna(False, ["_moved"]))
        table = written(judged.drop("_was", "_candidate", "_marked_at"), "open")
        rows = table.drop("_moved") if dedupe == ID else table.filter("_moved").drop("_moved")
        done = table.filter("NOT _moved").drop("_moved")
        if table.filter("_moved").isEmpty():
            return done if settled is None else settled.unionByName(done)
        if dedupe == ID_AND_KEY:
            settled = done if settled is None else settled.unionByName(done)


def event_outcomes(
    gated: DataFrame,
    state: DataFrame | None = None,
    marks: DataFrame | None = None,
    ttl_seconds: int = model.MARK_TTL_SECONDS,
    hot_rows: int = blocks.HOT_ROWS,
    dedupe: str = ID_AND_KEY,
    total: int | None = None,
) -> DataFrame:
    """One row per delivered message with ``result`` = applied, rejected, skipped or dlq.

    Events count in offset order. An event whose id was applied within the time
    limit before it is skipped; of the others one applies if its version beats
    that of its key's state, else it is rejected. Log time is the clock, so a
    re-run gives the same labels. With ``dedupe="id"`` an id applied on one key is
    skipped on every other one too; the default remembers it for its key, so that
    snapshot rows that share an id are not lost.

    The labels are computed here and read back from the shared folder: whether
    keys are left open has to be known. ``total`` is a bound of all rows, state and
    marks included, where the caller knows one: few rows have no hot key to look for. A key with more than ``hot_rows`` rows is
    resolved in blocks of its offsets. Text and row images are null but for dead
    letters, so the shuffle moves narrow rows.
    """
    _mark_scope(dedupe)
    passing = gated.filter(F.col("dlq_reason").isNull()).drop(*_BULKY)
    dead = gated.filter(F.col("dlq_reason").isNotNull())
    seeds = _seeds(state, marks)
    # The state and marks of a key join its window, so they count.
    hot = (None, hot_rows) if total is not None and total <= hot_rows else blocks.hot_keys(_with_seeds(passing.select(*KEY, "kafka_offset"), seeds), KEY, hot_rows)
    labels = labelled(passing, seeds, ttl_seconds, hot)
    if dedupe == ID:
        labels = _open_by_id(labels)
    labels = written(labels, "labels")
    left = labels.filter("_open")
    if not left.isEmpty():
        if dedupe == ID:  # marks of an id lie on the key that it was applied on
            own = left.filter(~F.col("_seed").eqNullSafe(_SEED_MARK))
            ids = own.select("event_id").distinct()
            left = own.unionByName(labels.filter(F.col("_seed") == _SEED_MARK).join(ids, "event_id", "left_semi"))
        labels = labels.filter("NOT _open").unionByName(_settled(left, ttl_seconds, dedupe, hot))
    result = F.when(F.col("_skipped"), F.lit(model.SKIPPED)).when(F.col("_applied"), F.lit(model.APPLIED))
    events = labels.filter(F.col("_seed").isNull()).withColumn("result", result.otherwise(F.lit(model.REJECTED)))
    everything = dead.withColumn("result", F.lit(model.DLQ)).unionByName(
        events.select(*passing.columns, "result"), allowMissingColumns=True
    )
    return everything.withColumn("latency_ms", sync_latency_ms())


def sync_latency_ms() -> Column:
    """Commit-to-apply time of applied events that carry a time."""
    return F.when(
        (F.col("result") == model.APPLIED) & F.col("event_time").isNotNull(),
        F.unix_millis("log_ts") - F.unix_millis("event_time"),
    )


def sync_latency(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("latency_ms").isNotNull()).select(
        "event_id",
        *KEY,
        "kafka_offset",
        (F.col("latency_ms") / F.lit(1000.0)).alias("latency_seconds"),
    )


def mark_applied(
    outcomes: DataFrame,
    marks: DataFrame | None = None,
    ttl_seconds: int = model.MARK_TTL_SECONDS,
    now: Column | None = None,
) -> DataFrame:
    """Marks after a batch: when an id was last applied; a repeat that is skipped does not extend its life.

    With ``now`` given, marks that have outlived the limit are dropped.
    """
    fresh = outcomes.filter(F.col("result") == model.APPLIED).select(
        "event_id", *KEY, F.col("log_ts").alias("marked_at")
    )
    rows = fresh if marks is None else marks.select(*fresh.columns).unionByName(fresh)
    merged = rows.groupBy("event_id", *KEY).agg(F.max("marked_at").alias("marked_at"))
    if now is None:
        return merged
    return merged.filter(F.unix_micros("marked_at") > F.unix_micros(now) - F.lit(ttl_seconds * 1_000_000))


def was_applied(
    events: DataFrame, marks: DataFrame, ttl_seconds: int = model.MARK_TTL_SECONDS, dedupe: str = ID_AND_KEY
) -> DataFrame:
    """Events with ``seen`` = the id was applied before (on its key, or on any) and its mark has not expired."""
    scope = _mark_scope(dedupe)
    held = marks.groupBy(*scope).agg(F.max("marked_at").alias("marked_at"))
    age = F.unix_micros("log_ts") - F.unix_micros("marked_at")
    return events.join(held, scope, "left").withColumn(
        "seen", F.coalesce(age < F.lit(ttl_seconds * 1_000_000), F.lit(False))
    ).drop("marked_at")


def mark_key(event_id: Column) -> Column:
    return F.concat(F.lit(model.MARK_PREFIX), event_id)


def as_state_rows(events: DataFrame, delete_mode: str = "reference") -> DataFrame:
    """Passing events in the shape of the read model, with the order fields of the upsert."""
    status = F.col("stock_status")
    if delete_mode == "tombstone":
        status = F.when(F.col("op") == model.OP_DELETE, F.lit("DELETED")).otherwise(status)
    elif delete_mode != "reference":
        raise ValueError(f"unknown delete mode {delete_mode!r}")
    return events.select(
        *KEY,
        F.col("available_qty").cast("int").alias("available_qty"),
        F.col("reserved_qty").cast("int").alias("reserved_qty"),
        status.alias("stock_status"),
        "row_version",
        F.col("event_id").alias("last_event_id"),
        F.col("commit_ts").alias("last_db_commit_ts"),
        F.col("log_ts").alias("updated_at"),
        "kafka_offset",
    )


def versioned_upsert(
    state: DataFrame | None, gated: DataFrame, delete_mode: str = "reference"
) -> DataFrame:
    """Next state: per key the row with the greatest version, the earlier one on a tie.

    Give it outcomes (rows with ``result``), and only applied events count, so
    state and outcomes cannot disagree, whatever ids are used again. Gated events
    without ``result`` all count; that is the same where an id means one version.

    State and events meet in one aggregation with map-side partials, so a key
    that receives a large part of the events reaches the shuffle as a few rows.
    """
    counted = F.col("result") == model.APPLIED if "result" in gated.columns else F.col("dlq_reason").isNull()
    rows = as_state_rows(gated.filter(counted), delete_mode)
    if state is not None:
        old = state.withColumn("kafka_offset", F.lit(_SEED_OFFSET).cast("bigint"))
        rows = old.select(*rows.columns).unionByName(rows)
    values = [f.name for f in model.STATE if f.name not in KEY]
    winner = F.max_by(F.struct(*values), F.struct("row_version", -F.col("kafka_offset")))
    return rows.groupBy(*KEY).agg(winner.alias("_row")).select(
        *KEY, *[F.col(f"_row.{v}").alias(v) for v in values]
    )


def ordering_check(gated: DataFrame, hot_rows: int = blocks.HOT_ROWS) -> DataFrame:
    """Passing events whose version does not exceed the greatest version before them in their key,
    and keys seen on a second partition: both break per-product order."""
    passing = gated.filter(F.col("dlq_reason").isNull()).select(
        *KEY, "event_id", "kafka_partition", "kafka_offset", "row_version"
    )
    seen = blocks.running(
        passing,
        KEY,
        "kafka_offset",
        {
            "previous_version": ("max", F.col("row_version")),
            "lowest_partition": ("min", F.col("kafka_partition")),
        },
        hot_rows,
        current=False,
    )
    return seen.select(
        "*",
        (F.col("row_version") <= F.col("previous_version")).alias("version_not_newer"),
        (F.col("kafka_partition") != F.col("lowest_partition")).alias("partition_changed"),
    ).filter(F.col("version_not_newer") | F.col("partition_changed")).drop("lowest_partition")


def id_conflicts(gated: DataFrame) -> DataFrame:
    """Ids that occur with more than one version on the same key: a report, ``event_outcomes`` settles them."""
    return (
        gated.filter(F.col("dlq_reason").isNull())
        .groupBy("event_id", *KEY)
        .agg(F.min("row_version").alias("lowest"), F.max("row_version").alias("highest"))
        .filter("lowest <> highest")
    )
