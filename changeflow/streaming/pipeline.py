"""The kernel under Structured Streaming.

Decode and gates run as part of the stream. Every micro-batch writes its events
once to the audit history, resolves them from there against state and marks, and
writes outcomes, dead letters, marks and state, each under the batch id. The checkpoint replaces offset commits: a batch that
fails part-way runs again under the same id and overwrites its own output.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow import model
from changeflow.model import KEY
from changeflow.operators import blocks
from changeflow.operators.contract import Contract, load_contract
from changeflow.operators.gates import dlq_envelope, gate
from changeflow.operators.resolve import ID, ID_AND_KEY, event_outcomes, mark_applied, versioned_upsert
from changeflow.functions.decode import decode
from changeflow.session import exists, scratch_scope
from changeflow.sinks.state import MarkTable, StateTable
from changeflow.sinks.tables import append_audit, audit_bytes, audit_day, dlq_messages, merge_into_table, write_dlq
from changeflow.sources.log import TRIGGER


@dataclass(frozen=True)
class Settings:
    """``merge_table`` names a catalog table that supports MERGE; it then holds the read model instead of files."""

    root: str
    contract: Contract | None = None
    buckets: int = 64
    ttl_seconds: int = model.MARK_TTL_SECONDS
    delete_mode: str = "reference"
    ignore_tombstones: bool = False
    check_types: bool = False
    warn_unknown_fields: bool = False
    apply_mapping: bool = False
    hot_rows: int = blocks.HOT_ROWS
    dedupe: str = ID_AND_KEY
    merge_table: str | None = None


class Pipeline:
    """Folders below ``root``: audit, outcomes, dlq, marks, state."""

    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark = spark
        self.settings = settings
        root = settings.root.rstrip("/")
        self.audit, self.outcomes_dir, self.dlq = f"{root}/audit", f"{root}/outcomes", f"{root}/dlq"
        self.state = StateTable(spark, f"{root}/state", settings.buckets)
        self.marks = MarkTable(spark, f"{root}/marks", settings.ttl_seconds)

    def events(self, log: DataFrame) -> DataFrame:
        """Decode and gates: stateless, so they are part of the streaming plan and planned once."""
        s = self.settings
        contract = s.contract or load_contract()
        decoded = decode(log, contract.mapping if s.apply_mapping else None)
        return gate(decoded, contract, s.ignore_tombstones, s.check_types, s.warn_unknown_fields)

    def read_model(self, only: list[int] | None = None) -> DataFrame:
        if self.settings.merge_table is None:
            return self.state.read(only)
        rows = self.spark.table(self.settings.merge_table).select([f.name for f in model.STATE])
        return rows if only is None else rows.filter(self.state.bucket_of().isin(only))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch of gated events; safe to repeat with the same id.

        Outcomes are written once: the read model may hold a part of the batch by
        the time it runs again, so what it was before can't be asked a second time.
        """
        with scratch_scope(self.spark):
            self._process(batch, batch_id)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        s = self.settings
        target = f"{self.outcomes_dir}/batch_id={batch_id}"
        passing = F.col("dlq_reason").isNull()
        # Parsed once: a pass for what the batch touches, then the history. Dates of a batch are few, its bucket lists
        # have at most ``buckets`` entries.
        batch.persist()
        try:
            days = batch.groupBy(audit_day().alias("day")).agg(
                audit_bytes(),
                F.min(F.unix_seconds("log_ts")),
                F.count(F.lit(1)),
                F.collect_set(F.when(passing, self.state.bucket_of())),
                F.collect_set(F.when(passing, self.marks.bucket_of())),
            ).collect()
            if not days:
                return
            # The stream runs in a session of its own, without adaptive execution; from
            # here on the batch is an ordinary table of the caller's session.
            events = append_audit(batch, self.audit, batch_id, self.spark, {r[0]: r[1] for r in days})
        finally:
            batch.unpersist()
        earliest, total = min(r[2] for r in days), sum(r[3] for r in days)
        touched, marked = (sorted({b for r in days for b in r[k]}) for k in (4, 5))
        before = self.read_model(touched)
        if exists(self.spark, f"{target}/_SUCCESS"):
            outcomes = self.spark.read.parquet(target)
            done = True
        else:
            done = False
            ids = events.filter(passing).select(*KEY, "event_id").distinct()
            marks = self.marks.read(batch_id, earliest, marked)
            scope = ["event_id"] if s.dedupe == ID else [*KEY, "event_id"]
            outcomes = event_outcomes(
                events.drop("event_date"),
                before.join(ids.select(*KEY).distinct(), KEY, "left_semi"),
                None if marks is None else marks.join(ids, scope, "left_semi"),
                s.ttl_seconds,
                s.hot_rows,
                s.dedupe,
                4 * total,  # a state row for each key at most, and hardly more than a mark for each id
            )

        def outcome_rows() -> None:
            if not done:
                outcomes.write.mode("overwrite").parquet(target)

        def dead_letters() -> None:
            dead = dlq_envelope(outcomes.filter(~passing))
            write_dlq(dlq_messages(dead), f"{self.dlq}/batch_id={batch_id}")

        def new_marks() -> None:
            self.marks.write(batch_id, mark_applied(outcomes))
            self.marks.forget(earliest)

        def next_state() -> None:
            if touched and s.merge_table is None and not self.state.is_staged(batch_id):
                self.state.stage(batch_id, versioned_upsert(before, outcomes, s.delete_mode))

        # These do not depend on each other; a failure of any fails the batch.
        with ThreadPoolExecutor(4) as pool:
            jobs = [pool.submit(inheritable_thread_target(self.spark)(f)) for f in (outcome_rows, dead_letters, new_marks, next_state)]
            for job in jobs:
                job.result()
        # Only now, with the outcomes and the staged copy whole, the read model changes.
        if touched and s.merge_table is not None:
            merge_into_table(versioned_upsert(None, outcomes, s.delete_mode), s.merge_table)
        elif touched:
            self.state.swap(batch_id)

    def outcomes(self) -> DataFrame:
        return self.spark.read.parquet(self.outcomes_dir)

    def start(self, log: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
        writer = self.events(log).writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER)
        return writer.start()
