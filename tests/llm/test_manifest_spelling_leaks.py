"""Merkle manifest, spelling variants and decontamination: odd tables against SQL, parts against plain code."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import compare, decontamination, merkle_manifest, spelling
from shelfcast.llm.oracle import ORACLE
from shelfcast.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = "item_id long, text string"
NEW = ["op11_merkle_manifest", "op12_spelling_variants", "op13_benchmark_decontamination"]


def _rows():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeÀàñ") for _ in range(rng.randint(4, 7))) for _ in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = prose(20_000)
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4),
        (4, "One two.", "en", "", 8), (5, "same", "en", "b", 4), (5, "same", "en", "b", 4),
        (5, "other", "en", "b", None), (6, long, "en", "c", len(long)), (7, "X" * 50_000, "en", "c", 50_000),
        (-8, f"{prose(20)} {passage.upper()} end é", "fr", "a", 0), (9, f"{passage[:90]}-{prose(9)}", "es", "é", 0),
        (None, f"lost {passage}", "en", "a", 0), (None, None, None, None, None), (None, "tied", "en", "a", 0),
        (2**62, prose(50), "en", "a", 0), (-(2**62), prose(50), "en", "a", 0),
    ]
    # One id and one source with very many rows, some of them alike.
    rows += [(77, f"copy {i % 150} {words[i % 60]}", "en", "hot", i % 3) for i in range(600)]
    rows += [(1000 + i, prose(30), "en", f"s{i % 40}", i) for i in range(400)]
    items = [
        (1, passage), (2, f"{prose(5)} {passage[:120]} {prose(5)}"), (3, None), (4, ""), (5, "two"),
        (6, "One, TWO"), (7, f"tied"), (7, "end é"), (None, "copy 7"), (8, passage), (9, prose(12)),
    ]
    return rows, items


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    rows, items = _rows()
    docs = spark.createDataFrame(rows, DOCS).withColumns(
        {"group": F.lit(1), "leaf": F.lit("x"), "word": F.lit(0), "row": F.lit(2), "slot": F.lit(3), "n": F.lit(4)}
    )
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, ITEMS).withColumn("win", F.lit(9)).write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.mark.parametrize("name", NEW)
def test_odd_tables_equal_sql(spark, odd, name):
    assert compare.difference(QUERIES[name](spark, odd), compare.connect(odd), ORACLE[name]) is None


@pytest.mark.parametrize("name", NEW)
def test_empty_tables_give_no_rows(spark, empty, name):
    frame = QUERIES[name](spark, empty)
    assert frame.collect() == []
    assert sorted(frame.columns) == sorted(d[0] for d in compare.connect(empty).execute(ORACLE[name]).description)


# --------------------------------------------------------------------------------------- manifest


@pytest.mark.parametrize("ids", [range(3000), [i * 2**40 - 2**55 for i in range(2000)], [-1, 0, 1, -(2**63), 2**63 - 1]])
def test_ranks_equal_sorted_positions(spark, ids):
    """Dense ids need one level of the directory, ids across 64 bits need five."""
    rng = random.Random(1)
    rows = [(rng.choice("ab"), i, rng.choice([1, 1, 3])) for i in ids]
    found = merkle_manifest._located(spark.createDataFrame(rows, "group string, id long, n long"))
    low, high = found.agg(F.min("at"), F.max("at")).first()
    index = merkle_manifest.rank_index(found, ["group"], (low ^ high).bit_length())
    got = found.join(index, ["group", "at"]).select("group", "id", merkle_manifest.rank("place"), "total").collect()
    for group in "ab":
        own = sorted((i, n) for g, i, n in rows if g == group)
        before = dict(zip([i for i, _ in own], itertools.accumulate([0, *(n for _, n in own)]), strict=False))
        total = sum(n for _, n in own)
        assert {(r[1], r[2], r[3]) for r in got if r[0] == group} == {(i, b, total) for i, b in before.items()}


def test_a_changed_leaf_does_not_verify(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    proofs = merkle_manifest.build(docs).proofs().select("item.digest", "root", "path")
    wrong = F.sha2(F.lit("another"), 256)
    seen = proofs.select(
        (merkle_manifest.fold(F.col("digest"), F.col("path")) == F.col("root")).alias("right"),
        (merkle_manifest.fold(wrong, F.col("path")) == F.col("root")).alias("wrong"),
    )
    assert {tuple(r) for r in seen.distinct().collect()} == {(True, False)}
    assert seen.count() == docs.count()


def test_a_lone_row_is_its_own_root(spark):
    one = spark.createDataFrame([(1, "t", "en", "a", 1)], DOCS)
    row = merkle_manifest.build(one).proofs().first()
    assert row["item"]["digest"] == row["subroot"] == row["root"] and row["path"] == []


# --------------------------------------------------------------------------------------- spelling


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_position_index_equals_pairwise_comparison():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abñ") for _ in range(rng.randint(6, 7))) for _ in range(300)})
    found = {(words[a], words[b]) for x, y in spelling._search(words) for a, b in zip(x, y, strict=True)}
    assert found == {(a, b) for a in words for b in words if _one_edit(a, b)}


def test_members_are_the_set_bits():
    flags = np.random.default_rng(3).random((5, 192)) < 0.05
    packed = np.packbits(flags, axis=1, bitorder="little").view(np.uint64)
    assert [list(x) for x in spelling.members(packed)] == [list(x) for x in np.nonzero(flags)]


def test_large_sets_are_divided_without_losing_pairs(spark, monkeypatch):
    """All words share a front or a back; a set of a handful is divided again and again."""
    rng = random.Random(4)
    words = {"prefix" + "".join(rng.choice("ab") for _ in range(rng.randint(5, 7))) for _ in range(200)}
    words |= {"".join(rng.choice("ab") for _ in range(6)) + "suffixes" for _ in range(60)}
    monkeypatch.setattr(spelling, "SET_WORDS", 4)
    given = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    found = {(r["word"], r["near"]) for r in spelling.near_words(given).collect()}
    assert found == {(a, b) for a in words for b in words if _one_edit(a, b)}


# ---------------------------------------------------------------------------------- decontamination


def test_fingerprints_cover_every_shared_span():
    """Two texts that share a span of the window's width have a fingerprint in common, wherever it lies."""
    rng = random.Random(6)
    for _ in range(50):
        span = [f"w{rng.randrange(30)}" for _ in range(decontamination.WIDTH)]
        texts = [
            " ".join([f"{p}{i}" for i in range(rng.randrange(12))] + span + [f"{p}x{i}" for i in range(rng.randrange(12))])
            for p in "pq"
        ]
        seen = []
        for text in texts:
            data = np.frombuffer(text.encode(), np.uint8)
            found = decontamination.Windows(data, np.array([0, len(data)]), decontamination.WIDTH, decontamination.GRAM)
            seen.append(set(found.fp.tolist()))
        assert seen[0] & seen[1]


def test_few_fingerprints_stand_for_all_windows():
    text = " ".join(f"w{i}" for i in np.random.default_rng(7).integers(0, 5000, 20_000))
    data = np.frombuffer(text.encode(), np.uint8)
    found = decontamination.Windows(data, np.array([0, len(data)]), decontamination.WIDTH, decontamination.GRAM)
    assert len(set(found.fp.tolist())) < 0.35 * len(found.fp)


def test_spans_and_items_of_a_hit(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l z"), (2, "nothing here")], "doc_id long, text string")
    items = spark.createDataFrame([(4, "x B C D e f g h i j k l y"), (5, "here")], ITEMS)
    rows = {r["doc_id"]: r for r in decontamination.contamination(docs, items).collect()}
    assert rows[1]["n_hit"] == 11 and rows[1]["items"] == ["4"]
    assert [tuple(s) for s in rows[1]["spans"]] == [(1, 11), (2, 12)]
    assert rows[2]["n_hit"] == 1 and rows[2]["items"] == ["5"]
