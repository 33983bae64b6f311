"""The read model kept in Spark's state store: a batch emits the rows of keys that changed, and rewrites nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow import model
from changeflow.model import KEY
from changeflow.operators.resolve import versioned_upsert
from changeflow.session import exists
from changeflow.sources.log import TRIGGER

#: State by key in RocksDB, so that a key's row needn't fit the heap and a batch writes changed keys only.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class ReadModelStream:
    """Follows a pipeline's outcomes. ``<root>/batch_id=N`` holds the new rows of the keys that batch N changed."""

    def __init__(self, spark: SparkSession, root: str, delete_mode: str = "reference"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.delete_mode = delete_mode

    def newest(self, outcomes: DataFrame) -> DataFrame:
        """Per key the applied row with the greatest version so far: an aggregation with state by key."""
        return versioned_upsert(None, outcomes, self.delete_mode)

    def _emit(self, changed: DataFrame, batch_id: int) -> None:
        # The batch owns its folder, so one that runs again replaces what it wrote.
        changed.write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")

    def start(
        self, outcomes_dir: str, checkpoint: str, available_now: bool = False, max_files_per_trigger: int | None = None
    ) -> StreamingQuery:
        """``outcomes_dir`` must hold outcomes of a first batch, whose schema the stream takes."""
        self.spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        reader = self.spark.readStream.schema(self.spark.read.parquet(outcomes_dir).schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        changed = self.newest(reader.parquet(outcomes_dir))
        writer = changed.writeStream.outputMode("update").foreachBatch(self._emit).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER)
        return writer.start()

    def changes(self) -> DataFrame:
        return self.spark.read.parquet(self.root)

    def current(self) -> DataFrame:
        """The whole read model: of each key's emitted rows the newest."""
        columns = [f.name for f in model.STATE]
        if not exists(self.spark, self.root):
            return self.spark.createDataFrame([], model.STATE)
        values = [c for c in columns if c not in KEY]
        newest = F.max_by(F.struct(*values), F.struct("row_version", "batch_id")).alias("_row")
        return self.changes().groupBy(*KEY).agg(newest).select(*KEY, "_row.*").select(columns)
