"""A Merkle manifest of a dataset: one tree per group, a tree over the groups' roots, and proofs.

Coordinates. A row's place in its group is a rank query on a compressed bitmap of the group's ids:
each partition sets bits in 64-bit words, words merge by bitwise or, empty words do not exist, and a
popcount directory says how many rows lie before each word. The directory is a radix tree over word
numbers; a node has at most 2^12 children, so no window in it grows with the data, and a dense id
range needs one or two levels. No group is sorted and none meets in one task.

Reduction. Nodes meet under the key (group, slot / 16) in an array indexed by slot mod 16. An array's
digest is a node of the next level; its entries are the siblings that proofs consist of.

Digests are lowercase hex sha256 of concatenated inputs. A field is ``-`` if null, else its UTF-8
byte count, ``:`` and its value.

Defined results: ids ascend with null first; rows that share an id follow the order of their leaf
digests, and identical rows take neighbouring slots, so each has a proof of its own. Null is a group
of its own, before all others; groups ascend bytewise. Empty and very long texts are ordinary
values. An empty table has no rows, trees or roots. Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.tables import stored

#: Children of a node.
FAN_OUT_BITS = 4
FAN_OUT = 1 << FAN_OUT_BITS
#: Bits of a word number that one level of the popcount directory resolves.
RADIX_BITS = 12
#: Orders signed ids as unsigned bit strings.
_SIGN = -(2**63)
#: Hex digits of a leaf that order rows with the same id before whole leaves are compared.
_TIE_DIGITS = 15

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(*map(field, values))


# ------------------------------------------------------------------------------- rank by bitmaps


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def _below(place: Column) -> Column:
    """Mask of the bits under a place."""
    return F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), place.cast("int")))


def _directory(nodes: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """``base``: rows of the same keys in nodes before; ``total``: rows of the keys.

    ``nodes`` has keys, a number ``at`` and its rows ``n``; numbers differ in the low ``bits`` only.
    """
    if bits <= RADIX_BITS:
        group = Window.partitionBy(*keys)
        before = group.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        return nodes.select(
            *keys, "at",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(group).alias("total"),
        )
    parent = F.shiftrightunsigned("at", RADIX_BITS)
    above = nodes.groupBy(*keys, parent.alias("at")).agg(F.sum("n").alias("n"))
    upper = _directory(above, keys, bits - RADIX_BITS).withColumnsRenamed({"at": "parent", "base": "parent_base"})
    before = Window.partitionBy(*keys, "parent").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    inner = nodes.withColumn("parent", parent).withColumn(
        "base", F.coalesce(F.sum("n").over(before), F.lit(0))
    )
    return inner.join(upper, [*keys, "parent"]).select(
        *keys, "at", (F.col("base") + F.col("parent_base")).alias("base"), "total"
    )


def rank_index(values: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """Compressed bitmaps with their directory: a row per word that has a bit.

    ``values`` has keys, ``at`` (word number), ``place`` (bit) and ``n``, rows of that value. Rows
    beyond the first of a value are kept beside the word, at most 64 entries.
    """
    words = values.groupBy(*keys, "at").agg(
        F.bit_or(_bit(F.col("place"))).alias("word"),
        F.collect_list(F.when(F.col("n") > 1, F.struct("place", (F.col("n") - 1).alias("extra")))).alias("more"),
        F.sum("n").alias("n"),
    )
    return words.drop("n").join(_directory(words.select(*keys, "at", "n"), keys, bits), [*keys, "at"])


def rank(place: str) -> Column:
    """Rows before a bit, given the columns of ``rank_index``."""
    earlier = F.filter("more", lambda m: m["place"] < F.col(place))
    return (
        F.col("base")
        + F.bit_count(F.col("word").bitwiseAND(_below(F.col(place))))
        + F.aggregate(earlier, F.lit(0).cast("long"), lambda acc, m: acc + m["extra"])
    )


def _located(rows: DataFrame) -> DataFrame:
    """Word number and bit of ``id``; a null id lies before all others."""
    value = F.col("id").bitwiseXOR(F.lit(_SIGN))
    at = F.shiftrightunsigned(value, 6).bitwiseOR(F.lit(1 << 58))
    return rows.withColumns(
        {
            "at": F.when(F.col("id").isNull(), F.lit(0)).otherwise(at),
            "place": F.coalesce(value.bitwiseAND(F.lit(63)), F.lit(0)),
        }
    )


def _tie_offsets(leaves: DataFrame) -> DataFrame:
    """Rows of the same id with smaller leaves, for ids that have several leaves."""
    keys = ["group", "at", "place"]
    several = leaves.groupBy(*keys).agg(F.count("*").alias("kinds")).filter("kinds > 1").drop("kinds")
    short = F.conv(F.substring("leaf", 1, _TIE_DIGITS), 16, 10).cast("long")
    tied = leaves.join(several, keys).select(
        *keys, "leaf", "copies",
        F.shiftrightunsigned(short, 6).alias("tie_at"), short.bitwiseAND(F.lit(63)).alias("tie_place"),
    )
    counts = tied.groupBy(*keys, "tie_at", "tie_place").agg(F.sum("copies").alias("n"))
    renamed = {"group": "k1", "at": "k2", "place": "k3", "tie_at": "at", "tie_place": "place"}
    found = rank_index(counts.withColumnsRenamed(renamed), ["k1", "k2", "k3"], 4 * _TIE_DIGITS - 6)
    same = Window.partitionBy("k1", "k2", "k3", "at", "place").orderBy("leaf")
    before = F.sum("copies").over(same.rowsBetween(Window.unboundedPreceding, -1))
    return (
        tied.withColumnsRenamed(renamed)
        .join(found, ["k1", "k2", "k3", "at"])
        .withColumn("offset", rank("place") + F.coalesce(before, F.lit(0)))
        .select(F.col("k1").alias("group"), F.col("k2").alias("at"), F.col("k3").alias("place"), "leaf", "offset")
    )


def _slots(leaves: DataFrame) -> DataFrame:
    """A row per input row with its ``slot`` in the group and the group's size ``n``."""
    found = _located(leaves)
    keys = ["group", "at", "place"]
    ids = found.groupBy(*keys).agg(F.sum("copies").alias("n"), F.count("*").alias("kinds"))
    low, high, kinds = ids.agg(F.min("at"), F.max("at"), F.max("kinds")).first()
    index = rank_index(ids.drop("kinds"), ["group"], ((low or 0) ^ (high or 0)).bit_length())
    placed = found.join(index, ["group", "at"]).withColumn("first", rank("place"))
    if (kinds or 0) > 1:
        placed = placed.join(_tie_offsets(found), [*keys, "leaf"], "left").withColumn(
            "first", F.col("first") + F.coalesce("offset", F.lit(0))
        )
    every = F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)
    return placed.select("group", F.explode(every).alias("slot"), F.col("total").alias("n"), "item")


# ------------------------------------------------------------------------------------ slot arrays


def _level(nodes: DataFrame) -> DataFrame:
    """Slot arrays of the level above ``nodes`` (group, slot, n, item); ``n``: nodes of the new level.

    A group of a single node is its own root: its array is marked ``lone`` and not hashed.
    """
    entry = F.struct((F.col("slot") % FAN_OUT).cast("int").alias("j"), "item")
    arrays = nodes.groupBy(
        "group", "n", F.shiftright("slot", FAN_OUT_BITS).alias("node")
    ).agg(F.map_from_entries(F.collect_list(entry)).alias("by_slot"))
    children = F.transform(F.sequence(F.lit(0), F.size("by_slot") - 1), lambda j: F.element_at("by_slot", j))
    return (
        arrays.withColumn("children", children)
        .withColumn("lone", F.col("n") == 1)
        .select(
            "group", "node", "lone", "children",
            F.shiftright(F.col("n") + (FAN_OUT - 1), FAN_OUT_BITS).alias("n"),
            F.when(F.col("lone"), F.col("children")[0]["digest"])
            .otherwise(F.sha2(_joined(F.col("children")), 256)).alias("digest"),
        )
    )


def _joined(children: Column) -> Column:
    return F.array_join(F.transform(children, lambda c: c["digest"]), "")


def _reduce(leaves: DataFrame, largest: int) -> list[DataFrame]:
    """All levels of slot arrays, lowest first; groups leave when one node remains."""
    levels = [stored(_level(leaves))]
    nodes = -(-largest // FAN_OUT)
    while nodes > 1:
        below = levels[-1].filter("n > 1")
        below = below.select("group", F.col("node").alias("slot"), "n", F.struct("digest").alias("item"))
        levels.append(stored(_level(below)))
        nodes = -(-nodes // FAN_OUT)
    return levels


def _roots(levels: Sequence[DataFrame]) -> DataFrame:
    """Group, root digest, and the level at which the group ended."""
    roots = None
    for height, level in enumerate(levels):
        ended = level.filter("n = 1").select("group", "digest", F.lit(height).alias("height"))
        roots = ended if roots is None else roots.unionByName(ended)
    return roots


_NO_PATH = "array<struct<left:string,right:string>>"


def _step(children: Column, j: Column) -> Column:
    """Siblings of child j, and below them nothing."""
    left, right = F.slice(children, 1, j), F.slice(children, j + 2, FAN_OUT)
    return F.array(F.struct(_joined(left).alias("left"), _joined(right).alias("right")))


def _walk(levels: Sequence[DataFrame], tops: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Paths of all leaves, from the roots down.

    ``tops``: group, height, the path above the group's root, and columns to hand down.
    Returns the leaves' items with the whole path, siblings level by level, leaf first.
    """
    above = None
    for height in reversed(range(len(levels))):
        given = tops.filter(F.col("height") == height).select(
            "group", F.lit(0).cast("long").alias("node"), "path", *carried
        )
        given = given if above is None else given.unionByName(above)
        met = levels[height].join(given, ["group", "node"])
        one = lambda c, j: F.struct(
            (F.col("node") * FAN_OUT + j).alias("slot"),
            c.alias("item"),
            F.when(F.col("lone"), F.col("path"))
            .otherwise(F.concat(_step(F.col("children"), j), F.col("path")))
            .alias("path"),
        )
        met = met.select("group", *carried, F.explode(F.transform("children", one)).alias("child"))
        above = met.select("group", F.col("child.slot").alias("node"), "child.path", *carried)
    return met.select("group", *carried, "child.item", "child.path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda below, step: digest(step["left"], below, step["right"]))


def path_digest(path: Column) -> Column:
    """Digest of a path's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


# --------------------------------------------------------------------------------------- manifest


def _ordered(groups: DataFrame) -> DataFrame:
    """Slots of the groups in bytewise order: range partitions, counted, then numbered inside."""
    numbered = stored(groups.orderBy("group").withColumn("number", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("number", 33)
    counts = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    # One row per partition of the sort, however many groups there are.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = F.col("number").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        numbered.withColumn("part", part).join(starts, "part")
        .select("group", "digest", "height", (F.col("start") + inside).alias("slot"))
    )


@dataclass(frozen=True)
class Manifest:
    """Stored levels of the groups' trees and of the tree above them; None for an empty table."""

    trees: tuple[DataFrame, ...]
    top: tuple[DataFrame, ...]
    leaves: DataFrame

    def proofs(self) -> DataFrame:
        """Every row's ``item`` (digest, id, carried), ``subroot``, ``root`` and ``path``."""
        if not self.trees:
            return self.leaves.select(
                "item", F.lit("").alias("subroot"), F.lit("").alias("root"), F.array().cast(_NO_PATH).alias("path")
            )
        root = _roots(self.top).select(
            "group", "height", F.col("digest").alias("root"), F.array().cast(_NO_PATH).alias("path")
        )
        groups = _walk(self.top, root, ["root"]).select(
            F.col("item.group").alias("group"), F.col("item.height").alias("height"),
            F.col("item.digest").alias("subroot"), "root", "path",
        )
        return _walk(self.trees, stored(groups), ["subroot", "root"]).select("item", "subroot", "root", "path")


def build(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    carried: Mapping[str, Column] | None = None,
) -> Manifest:
    """Trees over the rows of ``docs``: a leaf per row, of its ``fields``, in order of ``key``.

    ``key`` and ``group`` must be among the fields. ``carried`` columns go with the leaves into the
    proofs and must follow from the fields.
    """
    name = F.coalesce(F.concat(F.lit("s"), docs[group].cast("string")), F.lit("n"))
    rows = docs.select(
        name.alias("group"),
        docs[key].cast("long").alias("id"),
        leaf_digest(*(docs[f] for f in fields)).alias("leaf"),
        F.struct(F.lit(0).alias("_"), *(c.alias(n) for n, c in (carried or {}).items())).alias("extra"),
    )
    leaves = rows.groupBy("group", "id", "leaf").agg(F.count("*").alias("copies"), F.first("extra").alias("extra"))
    leaves = stored(
        leaves.select(
            "group", "id", "leaf", "copies",
            F.struct(F.col("leaf").alias("digest"), "id", *(F.col(f"extra.{n}").alias(n) for n in carried or {}))
            .alias("item"),
        )
    )
    sizes = leaves.groupBy("group").agg(F.sum("copies").alias("n"))
    groups, largest = sizes.agg(F.count("*"), F.max("n")).first()
    if not groups:
        return Manifest((), (), leaves)
    trees = _reduce(_slots(leaves), largest)
    above = _ordered(_roots(trees)).select(
        F.lit("").alias("group"), "slot", F.lit(groups).cast("long").alias("n"),
        F.struct("digest", "group", "height").alias("item"),
    )
    return Manifest(tuple(trees), tuple(_reduce(above, groups)), leaves)
