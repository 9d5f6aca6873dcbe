"""Standardized columns and vector access."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def standardize(
    df: DataFrame, columns: list[str], suffix: str = "_scaled", training: DataFrame | None = None
) -> DataFrame:
    """Mean 0 and sample deviation 1 for each column present; a constant column gives 0.

    Means and deviations are one scalar subquery over one aggregate of the training rows.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    moments = (df if training is None else training).agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in present],
            *[F.stddev_samp(c).alias(f"{c}_dev") for c in present],
        ).alias("moments")
    )

    return _scaled(df, moments, present, suffix)


def _scaled(df: DataFrame, moments: DataFrame, columns: list[str], suffix: str) -> DataFrame:
    def scaled(c: str) -> Column:
        mean, dev = F.col("moments")[f"{c}_mean"], F.col("moments")[f"{c}_dev"]
        spread = F.when(dev > 0, (F.col(c) - mean) / dev)
        return F.when(F.col(c).isNotNull(), F.coalesce(spread, F.lit(0.0)))

    return (
        df.withColumn("moments", moments.scalar())
        .withColumns({f"{c}{suffix}": scaled(c) for c in columns})
        .drop("moments")
    )


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: count, mean and sum of squared deviations (null without values); they merge."""
    parts = [
        F.struct(
            F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).cast("double").alias("mean"),
            (F.var_pop(c) * F.count(c)).alias("m2"),
        )
        for c in columns
    ]
    return df.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def merged_moments(parts: DataFrame) -> DataFrame:
    """Moments of several sets of rows as those of their union, one row per column.

    Parts merge pairwise (Chan's rule), in the order of their values, so the result does not depend
    on partitioning. A column's parts meet in one row: one of 24 bytes per stored run.
    """
    part = F.struct(F.col("n").cast("double").alias("n"), "mean", "m2")
    none = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "mean", "m2")])

    def merge(a: Column, b: Column) -> Column:
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + gap * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n).alias("m2"),
        )

    known = parts.filter("n > 0").groupBy("column").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    merged = known.select("column", F.aggregate("parts", none, merge).alias("all"))
    return merged.select("column", F.col("all.n").cast("long").alias("n"), "all.mean", "all.m2")


def standardize_by(df: DataFrame, merged: DataFrame, columns: list[str], suffix: str = "_scaled") -> DataFrame:
    """As ``standardize``, by stored moments instead of a pass over the rows."""
    present = [c for c in columns if c in df.columns]
    dev = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    own = lambda c, value: F.max(F.when(F.col("column") == c, value))
    fields = [own(c, F.col("mean")).alias(f"{c}_mean") for c in present]
    fields += [own(c, dev).alias(f"{c}_dev") for c in present]
    return _scaled(df, merged.agg(F.struct(*fields).alias("moments")), present, suffix) if present else df


def vector_columns(df: DataFrame, vector: str, names: list[str]) -> DataFrame:
    """Elements of a vector as columns of their own."""
    elements = vector_to_array(F.col(vector))
    return df.withColumns({name: elements[i] for i, name in enumerate(names)}).drop(vector)
