"""Helpers the operators share: tables, written intermediates, free column names, word patterns."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: What the contracts call a word.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED_WORD = r"[^\x20\x09-\x0D]+"


#: Documents may be long: a batch between the JVM and a Python worker holds so many rows and bytes at most, not Spark's 10,000 and 64 MB.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators with Python in their tasks.

    Small batches keep workers and the JVM's buffers small. Workers on this
    machine find this package wherever the driver was started; a cluster gets it
    with --py-files.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


_caches: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What an operator keeps in a worker process between its tasks.

    Another operator's first task there frees it, and gives back to the system what
    the allocators hold of memory that was in use before.
    """
    if owner not in _caches:
        _caches.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps the memory
            ctypes.CDLL(None).malloc_trim(0)
        _caches[owner] = {}
    return _caches[owner]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """The column of exactly this name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def free(df: DataFrame, *names: str) -> list[str]:
    """Each name, lengthened until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


_made: list[str] | None = None


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` as a table of its own in the shared folder, partitioned ``by`` a column if given.

    It cuts lineage: a lost executor re-reads files instead of repeating the
    work, and several readers share one run.
    """
    path = scratch_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    if _made is not None:
        _made.append(path)
    if by is None:
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)
    df.write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # a table without rows has no partitions to see it from


def folder_of(table: DataFrame) -> str:
    """Where ``written`` put it."""
    return re.sub(r"/([^/]*=[^/]*/)*[^/]*$", "", table.inputFiles()[0])


@contextlib.contextmanager
def listing_tables(into: list[str]) -> Iterator[None]:
    """Paths of the tables written inside go to the list, for who knows when they are no longer read."""
    global _made
    outer, _made = _made, into
    try:
        yield
    finally:
        _made = outer


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
