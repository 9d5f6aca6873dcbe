"""Mixing sources to target weights by balanced (cube-method) sampling.

Every source gets a target in words: weights share a budget, no source takes more than a cap
times its own size, and what a capped source leaves is shared again. A document is taken whole a
fixed number of times plus once more with the fractional probability that is left. The cube
method draws these last copies: it moves the probabilities along directions that change neither
the words nor the number of documents taken, until each is 0 or 1.

A flight works on a block of a source and leaves at most two fractional documents, so a source of
any size is flown in blocks and the leftovers of all blocks are flown again, until one block is
left. Only its last documents, two at most, cannot move any more; the landing rounds them to the
nearest total and lets one pair of that block trade places where that comes nearer. Blocks follow a
hash of the document's id, size and number among the rows that share both, so that no id fills a
block, and draws are seeded by source, round and block, so reruns agree.

Defined results: a null or empty text has size 0 and takes 0 words; a null source is a source of
its own, last in order; rows with a repeated or null id are drawn row by row; further columns are
left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Words to take in all, as a share of all words, and the most a source may take of its own.
BUDGET, CAP = 1.5, 2.0
#: Documents of one flight.
BLOCK = 4096
#: Rows alike that are numbered at once.
_STRETCH = 65536
SEED = 20240611
_NEAR = 1e-9


def sized(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """Per row: id, source, size, and its number among the rows that agree in all three.

    Rows alike are counted before they move and written out again by stretches, so many null or
    repeated ids pass through no single group.
    """
    rows = docs.select(
        docs[key].cast("long").alias("doc_id"),
        docs[source].cast("string").alias("source"),
        F.coalesce(F.regexp_count(docs[text], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    alike = rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    stretches = F.explode(F.expr(f"sequence(0L, (n - 1) div {_STRETCH})"))
    first = F.col("stretch") * _STRETCH
    numbers = F.explode(F.sequence(first + 1, F.least(first + _STRETCH, F.col("n"))))
    return alike.withColumn("stretch", stretches).select("doc_id", "source", "size", numbers.alias("number"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """Per source: its words, its documents and the words it is to give.

    A source is capped exactly when the level of all sources that reach their cap sooner, per
    weight, lies above its own cap; one pass in that order finds them. The frame has a row per
    source, so its windows are small.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = by_source.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights)) + 1)
    ).withColumn("most", cap * F.col("source_size"))
    everything = Window.partitionBy()
    sooner = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = sooner.rowsBetween(Window.unboundedPreceding, -1)
    total = budget * F.sum("source_size").over(everything)
    nothing = F.lit(0.0)
    level = (total - F.coalesce(F.sum("most").over(earlier), nothing)) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), nothing)
    )
    capped = weighed.withColumns({"total": total, "capped": level * F.col("weight") >= F.col("most")})
    free = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    used = F.coalesce(F.sum(F.when(F.col("capped"), F.col("most"))).over(everything), nothing)
    target = F.when(F.col("capped"), F.col("most")).otherwise(
        (F.col("total") - used) * F.col("weight") / free
    )
    return capped.select("source", "source_size", "n_docs", target.alias("target"))


def fly(sizes: np.ndarray, shares: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves fractional shares inside their block until two at most are fractional.

    Each step takes three fractional units and moves along the vector that leaves both their
    number and their size unchanged, up or down so that shares keep their expectation.
    """
    shares = shares.copy()
    waiting = [int(i) for i in np.flatnonzero((shares > _NEAR) & (shares < 1 - _NEAR))][::-1]
    value, weight = shares.tolist(), sizes.tolist()
    held: list[int] = []
    draws = iter(rng.random(len(waiting) + 1).tolist())
    while True:
        while len(held) < 3 and waiting:
            held.append(waiting.pop())
        if len(held) < 3:
            # Two units of one size can still trade places.
            if len(held) < 2 or weight[held[0]] != weight[held[1]]:
                break
            direction = (1.0, -1.0)
        else:
            a, b, c = (weight[i] for i in held)
            direction = (b - c, c - a, a - b)
            if a == b == c:
                direction = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, d in zip(held, direction, strict=True):
            if d > 0:
                up, down = min(up, (1 - value[i]) / d), min(down, value[i] / d)
            elif d < 0:
                up, down = min(up, value[i] / -d), min(down, (1 - value[i]) / -d)
        step = up if next(draws, 0.5) * (up + down) < down else -down
        still = []
        for i, d in zip(held, direction, strict=True):
            x = value[i] + step * d
            if x < _NEAR or x > 1 - _NEAR:
                value[i] = 0.0 if x < 0.5 else 1.0
            else:
                value[i] = x
                still.append(i)
        held = still
    return np.array(value)


def land(sizes: np.ndarray, shares: np.ndarray, wanted: float) -> np.ndarray:
    """Rounds the last fractional units, two at most, towards the size that is wanted in all.

    If one taken and one other unit, traded, come nearer still, they trade places.
    """
    taken = np.where(shares < _NEAR, 0.0, np.where(shares > 1 - _NEAR, 1.0, shares))
    last = np.flatnonzero((taken > 0) & (taken < 1))
    settled = float((np.where((taken > 0) & (taken < 1), 0.0, taken) * sizes).sum())
    options = [[(m >> i) & 1 for i in range(len(last))] for m in range(1 << len(last))]
    taken[last] = min(options, key=lambda o: (abs(settled + float(np.dot(o, sizes[last])) - wanted), o))
    gap = wanted - float((taken * sizes).sum())
    inside, outside = np.flatnonzero(taken == 1), np.flatnonzero(taken == 0)
    if len(inside) and len(outside):
        ranked = outside[np.argsort(sizes[outside], kind="stable")]
        goal = sizes[inside] + gap
        at = np.searchsorted(sizes[ranked], goal)
        pairs = [(np.clip(at + d, 0, len(ranked) - 1)) for d in (-1, 0)]
        misses = np.stack([np.abs(sizes[ranked[p]] - goal) for p in pairs])
        side, i = np.unravel_index(int(np.argmin(misses)), misses.shape)
        if misses[side, i] < abs(gap):
            taken[inside[i]], taken[ranked[pairs[side][i]]] = 0.0, 1.0
    return taken


_UNIT = (
    "doc_id long, source string, size long, number long, source_size long, target double, whole long, share double"
)


def _round(units: DataFrame, turn: int, block: int, seed: int) -> DataFrame:
    """One flight of every block; a source of a single block is landed too."""
    counts = units.groupBy("source").agg(F.ceil(F.count("*") / block).alias("blocks"))
    placed = units.join(counts, units["source"].eqNullSafe(counts["source"])).drop(counts["source"])
    draw = F.xxhash64("doc_id", "size", "number", F.lit(seed), F.lit(turn))
    dealt = placed.withColumn("block", F.pmod(draw, F.col("blocks")))

    def one(rows: pa.Table) -> pa.Table:
        order = rows.sort_by([(n, "ascending") for n in ("size", "doc_id", "number")])
        sizes = order.column("size").to_numpy().astype(float)
        shares = order.column("share").to_numpy()
        name = order.column("source")[0].as_py()
        number_of_name = int.from_bytes((name or "\0").encode()[:64].ljust(8, b"\0"), "little")
        key = [seed, turn, order.column("block")[0].as_py(), number_of_name]
        rng = np.random.default_rng(np.random.SeedSequence(key))
        # A random order lets the two units that are left have any size.
        shuffle = rng.permutation(len(sizes))
        moved = np.empty(len(sizes))
        moved[shuffle] = fly(sizes[shuffle], shares[shuffle], rng)
        if order.column("blocks")[0].as_py() == 1:
            moved = land(sizes, moved, float((shares * sizes).sum()))
        kept = ["doc_id", "source", "size", "number", "source_size", "target", "whole"]
        return pa.table([*order.select(kept).columns, pa.array(moved)], names=[*kept, "share"])

    return dealt.groupBy("source", "block").applyInArrow(one, _UNIT)


def mix(sizes: DataFrame, goals: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Per document: size, its source's words and target, copies taken and words taken.

    ``sizes`` are rows of ``sized``; without a ``number``, ids are taken to be unique.
    """
    if "number" not in sizes.columns:
        sizes = sizes.withColumn("number", F.lit(1).cast("long"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = (
        sizes.join(goals, sizes["source"].eqNullSafe(goals["source"]))
        .drop(goals["source"])
        .select(
            "doc_id", "source", "size", "number", "source_size", "target",
            F.floor(rate).cast("long").alias("whole"),
            (rate - F.floor(rate)).alias("share"),
        )
    )
    fractional = (F.col("share") > 0) & (F.col("share") < 1)
    done, turn = None, 0
    units = stored(units)
    while True:
        settled = units.where(~fractional)
        done = settled if done is None else done.unionByName(settled)
        left = units.where(fractional)
        if left.isEmpty():
            break
        units = stored(_round(left, turn, block, seed))
        turn += 1
    copies = F.col("whole") + F.col("share").cast("long")
    return done.select(
        "doc_id", "source", "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def mix_documents(docs: DataFrame, **kwargs) -> DataFrame:
    sizes = stored(sized(docs))
    return mix(sizes, targets(sizes), **kwargs)


def mixed(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """The documents with all their columns, each as often as the mix takes it.

    Rows of one id and text are one document; its copies are drawn together.
    """
    hashed = docs.withColumn("_unit", F.xxhash64(docs[key], F.coalesce(docs[text], F.lit(""))))
    drawn = mix_documents(hashed.select(F.col("_unit").alias("doc_id"), docs[text].alias("text"), docs[source].alias("source")))
    copies = drawn.groupBy(F.col("doc_id").alias("_unit")).agg(F.sum("copies").cast("int").alias("_copies"))
    taken = hashed.dropDuplicates(["_unit"]).join(copies.where("_copies > 0"), "_unit")
    many = F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")
    return taken.select(*docs.columns, many).select(*docs.columns)
