"""Session helpers and the shared folder where jobs write tables to cut lineage."""

from __future__ import annotations

import hashlib
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: set[str] = set()
_local_dirs: dict[str, str] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench. A cluster passes its own session in."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("changeflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Recording the Python line of every column operation costs more than small queries do.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Event times are instants; the test tables store them without a zone, as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder made here.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="changeflow-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/changeflow/{spark.sparkContext.applicationId}/{name}"


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _folder(spark, path)
    return fs.exists(at)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if it isn't there."""
    fs, at = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _folder(spark, path)
    fs.delete(at, True)


_scope = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that ``written`` makes inside, on this thread, are deleted at the end: for work that runs again and again."""
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        for path in _scope.paths:
            delete(spark, path)
        _scope.paths = outer


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of its own in the shared folder: lineage ends there, and several readers share one run."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Plans run inside take no generated method above the 8,000 bytes up to which the JVM compiles one.

    A longer method, such as decode and gate give, is interpreted row by row; without it Spark cuts the expressions into
    methods of their own.
    """
    before = spark.conf.get(_METHOD_LIMIT)
    spark.conf.set(_METHOD_LIMIT, "8000")
    try:
        yield
    finally:
        spark.conf.set(_METHOD_LIMIT, before)


def stage(spark: SparkSession, name: str, of: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Write ``build()`` once per application to the shared folder and read it back.

    The table cuts the lineage: a lost executor re-reads files instead of
    re-parsing the log, and several consumers share one parse. ``of`` names the
    input the table was derived from, so two inputs never share a table.
    """
    path = scratch_path(spark, f"{name}-{hashlib.md5(of.encode()).hexdigest()[:12]}")
    if path not in _written:
        with small_methods(spark):
            build().write.mode("overwrite").parquet(path)
        _written.add(path)
    return spark.read.parquet(path)
