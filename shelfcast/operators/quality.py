"""Data-quality checks: each gives one row with the number of failures, 0 meaning passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.cleaning import keep_complete


def not_null(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """Null rows of several columns, in one aggregate over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    checks = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns]
    )
    return counts.select(F.lit(model).alias("model"), F.inline(checks))


def unique(df: DataFrame, model: str, key: list[str]) -> DataFrame:
    """Number of key values that occur more than once; nulls do not count as values."""
    repeated = (
        keep_complete(df, key)
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(",".join(key)).alias("column_name"), "failures"
    )


def _whole_number(df: DataFrame, name: str) -> Column | None:
    """A key column of whole numbers or days as 64 bits, None for other types."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint")
    return F.col(name).cast("bigint") if isinstance(kind, T.IntegralType) else None


def _key_rows(check: int, key: list[str], df: DataFrame, width: int) -> DataFrame:
    """Keys of one table as ``width`` numbers, null beyond its own, and text for what is no number."""
    numbers = {c: _whole_number(df, c) for c in key}
    own = [n for n in numbers.values() if n is not None]
    texts = [c for c, n in numbers.items() if n is None]
    slots = own + [F.lit(None).cast("bigint")] * (width - len(own))
    return keep_complete(df, key).select(
        F.lit(check).alias("check"),
        *[slot.alias(f"key_{i}") for i, slot in enumerate(slots)],
        (F.to_json(F.struct(*texts)) if texts else F.lit(None).cast("string")).alias("key"),
    )


def unique_keys(keyed: list[tuple[str, list[str], DataFrame]]) -> DataFrame:
    """``unique`` for the keys of any number of tables, in one shuffle by check and key.

    Whole numbers and dates are compared as numbers, which take a fraction of the memory of text;
    the JSON form of other key columns tells any two values apart. Repeats collapse before they move,
    so no key value is too frequent.
    """
    width = max(len(key) for _, key, _ in keyed)
    rows = [_key_rows(i, key, df, width) for i, (_, key, df) in enumerate(keyed)]
    by = ["check", *[f"key_{i}" for i in range(width)], "key"]
    times = reduce(DataFrame.unionByName, rows).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    repeated = [(F.col("check") == i) & (F.col("n") > 1) for i in range(len(keyed))]
    found = times.agg(*[F.count_if(r).alias(f"check_{i}") for i, r in enumerate(repeated)])
    checks = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                F.lit(",".join(key)).alias("column_name"),
                F.col(f"check_{i}").alias("failures"),
            )
            for i, (model, key, _) in enumerate(keyed)
        ]
    )
    return found.select(F.inline(checks))


def all_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
