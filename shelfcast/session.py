"""Session settings, and the shared folder for tables that several jobs need."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "shelfcast", **conf) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="shelfcast-warehouse-"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder that all executors share: the cluster's own, a temporary one only on ``local``."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="shelfcast-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


# Where this application, or the run within it, keeps its tables.
_RUN: ContextVar[str] = ContextVar("run", default="shared")


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/shelfcast-{spark.sparkContext.applicationId}"


def _hadoop_path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def scratch_path(spark: SparkSession) -> str:
    """A new folder for a table that several jobs need."""
    return f"{_scratch_root(spark)}/{_RUN.get()}/{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession, run: str | None = None) -> None:
    """Removes the tables that this application stored, or those of one run."""
    root = _scratch_root(spark)
    files, path = _hadoop_path(spark, root if run is None else f"{root}/{run}")
    files.delete(path, True)
    if run is None:
        _SHARED.clear()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are removed at the end, when the results have been written."""
    run = uuid.uuid4().hex
    token = _RUN.set(run)
    try:
        yield
    finally:
        _RUN.reset(token)
        clear_scratch(spark, run)


#: Rows of a stored file at most, and bytes of a task that reads files one by one.
FILE_ROWS, TASK_BYTES = 250_000, 16 << 20


def stored_once(df: DataFrame) -> DataFrame:
    """Writes a frame that several jobs need to the shared folder and reads it back.

    Later jobs prune its columns and survive lost executors without computing it again. Files have a
    bounded number of rows, so that ``small_tasks`` can bound those of a task.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Jobs run meanwhile read about ``TASK_BYTES`` per task, however large the table.

    For jobs whose tasks keep or sort all they read, which may be many times its size in the files.
    """
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key, None)
    context = spark.sparkContext
    now = context._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) if before else TASK_BYTES
    spark.conf.set(key, str(min(now, TASK_BYTES)))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


_SHARED: dict[tuple[str, ...], DataFrame] = {}


def shared(name: str, folder: str, spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """A table that several queries of an application derive from one folder, written once.

    The version of the folder is part of its key, so changed inputs are derived again.
    """
    files, path = _hadoop_path(spark, folder)
    newest = max((s.getModificationTime() for s in files.listStatus(path)), default=0)
    version = f"{files.getContentSummary(path).getLength()}-{newest}"
    key = (spark.sparkContext.applicationId, name, folder, version)
    if key not in _SHARED:
        _SHARED[key] = stored_once(make())
    return _SHARED[key]
