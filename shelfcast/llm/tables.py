"""Reads the tables of a folder and keeps intermediate tables in the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shelfcast.session import ensure_checkpoint_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Writes a frame to the shared folder and reads it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


#: Bytes of an Arrow batch that a function gets at once, about; what it holds grows with them.
SLICE_BYTES = 8 << 20


def release() -> None:
    """Gives freed memory back to the system; a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """Runs ``fn`` on slices of every Arrow batch; it yields columns by name, of one length."""
    target = arrow_schema(schema)

    def run(batches):
        for part in (part for batch in batches for part in _slices(batch)):
            for columns in fn(part):
                arrays = [
                    columns[f.name]
                    if isinstance(columns[f.name], pa.Array)
                    else pa.array(columns[f.name], f.type, from_pandas=False)
                    for f in target
                ]
                yield pa.RecordBatch.from_arrays(
                    [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, target, strict=True)],
                    schema=target,
                )
            release()

    return df.mapInArrow(run, schema)


def shuffle_width(df: DataFrame) -> int:
    """Partitions of a shuffle as the session sets them, for keys that are dealt by number."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


__all__ = ["arrow_schema", "map_batches", "release", "shuffle_width", "stored", "table"]
