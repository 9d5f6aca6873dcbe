"""CSV and table readers, rejected lines, table sinks, views."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from shelfcast.functions.columns import parse_mixed_date
from shelfcast.operators.cleaning import SERIES, as_date
from shelfcast.sources import schemas


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header checked against the schema; ``NA`` reads as null."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", "NA")
        .csv(path)
    )


def read_stores(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_STORES)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Economic and markdown table; its holiday column would clash with that of sales."""
    raw = read_csv(spark, path, schemas.RAW_FEATURES).drop("isholiday")
    return raw.withColumn("date", parse_mixed_date("date"))


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    raw = read_csv(spark, path, schemas.RAW_SALES)
    return raw.withColumn("date", parse_mixed_date("date"))


# --- files whose lines may be wrong ---------------------------------------------------

# Why a line is rejected, in the order in which the reasons are tried.
MALFORMED, BAD_DATE, NO_KEY = "malformed", "unreadable date", "missing key"

_RAW = "rejected_line"


def parse_lines(lines: DataFrame, schema: StructType, keys: list[str], line: str = "value") -> DataFrame:
    """Columns of each CSV line with the ``line`` and the ``reason`` it is rejected for, else null.

    A line is malformed when a value does not have its column's type or the number of values is
    wrong. ``NA`` and empty values are null, which only keys must not be. A ``date`` column is parsed
    as one of the accepted formats.
    """
    typed = StructType([*schema.fields]).add(_RAW, StringType())
    options = {"nullValue": "NA", "columnNameOfCorruptRecord": _RAW, "mode": "PERMISSIVE"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in typed)
    # A generator's row is computed once; plain columns would parse a line wherever one of them is used.
    parsed = lines.select(F.col(line).alias("line"), F.inline(F.array(F.from_csv(line, ddl, options))))
    reason = F.when(F.col(_RAW).isNotNull(), MALFORMED)
    if "date" in schema.names:
        written = F.col("written_date")
        parsed = parsed.withColumnRenamed("date", "written_date").select(
            "*", F.inline(F.array(F.struct(parse_mixed_date("written_date").alias("date"))))
        )
        reason = reason.when(written.isNotNull() & F.col("date").isNull(), BAD_DATE)
    missing = [F.col(k).isNull() for k in keys]
    for m in missing:
        reason = reason.when(m, NO_KEY)
    return parsed.withColumn("reason", reason).select(*schema.names, "line", "reason")


def read_lines(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows of CSV files with a header, and rejected lines with their reason.

    Every line but the header is in exactly one of the two, so their counts add up to the file's.
    """
    text = spark.read.text(path)
    header = text.first()
    names = [n.strip().lower() for n in header["value"].split(",")] if header else []
    if header and names != schema.names:
        raise ValueError(f"header {names} does not match {schema.names}")
    lines = text.filter(F.col("value") != header["value"]) if header else text
    parsed = parse_lines(lines.filter(F.trim("value") != ""), schema, keys)
    rejected = parsed.filter(F.col("reason").isNotNull()).select("line", "reason")
    return parsed.filter(F.col("reason").isNull()).drop("line", "reason"), rejected


def _is_path(target: str) -> bool:
    return "/" in target


def exists(spark: SparkSession, target: str) -> bool:
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def partition_columns(spark: SparkSession, target: str) -> list[str]:
    """Columns that the table itself is partitioned by; a data column of the same name is none."""
    if not _is_path(target):
        return [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
    return sorted({n.partition("=")[0] for n in names if "=" in n})


def read_table(
    spark: SparkSession,
    target: str,
    first: dt.date | str | None = None,
    last: dt.date | str | None = None,
) -> DataFrame:
    """Catalog table, or Parquet folder when the target is a path.

    ``first`` and ``last`` bound ``date``. A table that is partitioned by ``year``, which writers
    derive from the date, is then read by partitions; on any other table a column called ``year``
    decides nothing.
    """
    df = spark.read.parquet(target) if _is_path(target) else spark.table(target)
    if first is None and last is None:
        return df
    by_year = "year" in partition_columns(spark, target)
    for bound, keeps in ((first, "__ge__"), (last, "__le__")):
        if bound is not None:
            df = df.filter(getattr(F.col("date"), keeps)(as_date(bound)))
            df = df.filter(getattr(F.col("year"), keeps)(F.year(as_date(bound)))) if by_year else df
    return df


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Write to one explicit catalog table or Parquet folder.

    A partitioned write is rebalanced by the partition columns first: each value lands
    in few files, and a value with very many rows is still split over several tasks.
    """
    keys = partition_by or []
    if keys:
        df = df.hint("rebalance", *[F.col(k) for k in keys])
    writer = df.write.mode(mode).partitionBy(*keys)
    if _is_path(target):
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def write_series_table(
    df: DataFrame, name: str, buckets: int, mode: str = "overwrite", partition_by: list[str] | None = None
) -> None:
    """Catalog table bucketed by series and sorted by date, within partitions where some are named.

    Windows and groups per series, and joins of two such tables under ``co_partitioned``, then need
    no shuffle. Only for one row per series and date, which bounds what a series adds to its bucket.
    """
    (
        df.repartition(buckets, *SERIES)
        .write.mode(mode)
        .partitionBy(*partition_by or [])
        .bucketBy(buckets, *SERIES)
        .sortBy(*SERIES, "date")
        .format("parquet")
        .saveAsTable(name)
    )


def append_table(df: DataFrame, target: str) -> None:
    """Add rows, creating the table if it is absent."""
    write_table(df, target, mode="append")


_RUN = re.compile(r"[A-Za-z0-9_.-]+")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of a write."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Plans made meanwhile join tables bucketed by series on longer keys without a shuffle.

    A bucket holds whole series, and a series at most one row per week, so joining on series and
    date by buckets cannot put more into a task than the buckets hold.
    """
    with _setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        yield


def write_run(df: DataFrame, target: str, run: str) -> None:
    """Rows of one run of a table that many runs add to: a partition of the table.

    A repeated run replaces its own rows and no others. Rows are staged and move in at the end, so
    one that breaks off leaves the rows of the earlier try.
    """
    if not _RUN.fullmatch(run):
        raise ValueError(f"a run is named by letters, digits, '_', '.' and '-', not {run!r}")
    spark = df.sparkSession
    keyed, seen = count_rows(df.withColumn("run", F.lit(run)), f"run {run} of {target}")
    if _is_path(target):
        writer = keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("run").parquet(target)
    elif spark.catalog.tableExists(target):
        with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            keyed.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
    else:
        keyed.write.partitionBy("run").format("parquet").saveAsTable(target)
    if seen.get["rows"]:
        return
    # Without rows no partition was replaced.
    if _is_path(target):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/run={run}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    else:
        spark.sql(f"alter table {target} drop if exists partition (run = '{run}')")


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def count_rows(df: DataFrame, name: str, required: list[str] | None = None) -> tuple[DataFrame, Observation]:
    """Row count, and null rows of each required column as ``null_<column>``.

    They are taken while the frame is written or read, without a job of their own.
    """
    seen = Observation(name)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required or []]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls), seen
