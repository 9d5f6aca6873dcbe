"""Connected components of an edge list, by alternating stars over shuffled edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.tables import map_batches, stored


def _contract(edges: DataFrame) -> DataFrame:
    """Replaces the edges of each batch by stars of the batch's own components."""

    def run(batch: pa.RecordBatch):
        u, v = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        names, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
        parent = list(range(len(names)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(ends[: len(u)].tolist(), ends[len(u) :].tolist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        tops = np.array([root(x) for x in range(len(names))], np.int64)
        child = np.flatnonzero(tops != np.arange(len(names)))
        yield {"u": names[child], "v": names[tops[child]]}

    return map_batches(edges, run, "u long, v long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(lowest, "u")
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .unionByName(lowest.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _is_star(edges: DataFrame) -> bool:
    """Every node below one other, and no node both below and above."""
    roles = edges.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        edges.select("v", F.lit(0), F.lit(1)).distinct().toDF("x", "below", "above")
    )
    wrong = roles.groupBy("x").agg(F.sum("below").alias("b"), F.sum("above").alias("a"))
    return wrong.where("b > 1 or (b > 0 and a > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that is not the smallest of its component.

    Each round first contracts what lies in one task, then alternates large and small stars; the
    rounds grow with the logarithm of the longest path.
    """
    now = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct()
    while True:
        now = stored(_small_star(_large_star(_contract(now))))
        if _is_star(now):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
