"""Spelling variants: words of a corpus that differ by one letter, grouped under their frequent form.

Near words by a bit-sliced position index. For a set of words there is a bitset per (position, letter):
which words have that letter there. A query's letters are read once; all words of the set are advanced
at the same time by operations on whole bitsets:

    zero      words equal to the query so far
    replaced  words with one other letter so far
    inserted  words with one letter more so far, read one position ahead
    deleted   words with one letter less so far, read one position behind

Sets. Of two words with one edit between them, whose shorter one has m letters, (m - 1) / 2 letters or
more at the front or at the back are equal. So words meet by m and by the front or the back; a set that
is too large is divided again by the same rule over the letters not yet compared, until it fits or too
few letters are left to divide, when it holds no more words than the alphabet allows. Every pair meets;
none is formed that is not near. Small sets share an index.

Defined results: a null text has no words. A null id counts as an empty string in an occurrence's name.
Each row counts, so repeated rows repeat their words. Ties between forms go to the smaller word in
code-point order. An empty table gives no words. Further columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import blocks
from shelfcast.llm.tables import arrow_schema, map_batches, release, stored

#: Fixed values of the corpus's spelling noise and of a word.
LETTERS = "a-zÀ-ÿ"
SLIP = 97
LEAST_LETTERS = 5
LEAST_COUNT = 3
#: A form is at least so many times as frequent.
FACTOR = 2

#: Words of an index, and letters in all its words, at most about so many.
INDEX_WORDS = 2048
INDEX_LETTERS = 1 << 16
#: Words of a set that is not divided further.
SET_WORDS = 512

_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

# ------------------------------------------------------------------------------------ vocabulary


def _slipped(run: str, name: int) -> str:
    """The run, or without one letter where its occurrence's hash says so."""
    if name % SLIP:
        return run
    at = name % len(run)
    return run[:at] + run[at + 1 :]


def count_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS
) -> DataFrame:
    """Words of ``least_letters`` or more and their occurrences ``n``; each slice counts before the shuffle."""
    pattern = re.compile(f"[{LETTERS}]{{{least_letters},}}")

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        found: Counter[str] = Counter()
        names = batch.column(0).to_pylist()
        for first, last, data, offsets in blocks.text_blocks(batch.column(1)):
            folded = data.tobytes().translate(_FOLD)
            for row, start, end in zip(range(first, last), offsets.tolist(), offsets[1:].tolist(), strict=False):
                runs = Counter(pattern.findall(folded[start:end].decode()))
                crc = zlib.crc32(f"{'' if names[row] is None else names[row]}:".encode())
                for run, n in runs.items():
                    name = zlib.crc32(run.encode(), crc)
                    found[run if name % SLIP else _slipped(run, name)] += n
        kept = [w for w in found if len(w) >= least_letters]
        yield {"word": kept, "n": [found[w] for w in kept]}

    counted = map_batches(docs.select(docs[key], docs[text]), count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# ----------------------------------------------------------------------------------------- sets


def _halves() -> Column:
    """The two sets that a row goes to: the next letters at the front, or at the back, are equal.

    ``m`` letters has the shorter word; ``front`` and ``back`` letters are compared already.
    """
    step = F.col("step")
    fore = F.substring("word", F.col("front") + 1, step)
    aft = F.substring("word", F.length("word") - F.col("back") - step + 1, step)
    return F.array(
        F.struct(F.xxhash64("set", F.lit(0), fore).alias("set"), (F.col("front") + step).alias("front"), "back"),
        F.struct(F.xxhash64("set", F.lit(1), aft).alias("set"), "front", (F.col("back") + step).alias("back")),
    )


def _divided(rows: DataFrame) -> DataFrame:
    half = F.explode(_halves()).alias("half")
    return rows.select("word", "n", "m", half).select("word", "n", "m", "half.*")


def sets(vocabulary: DataFrame) -> DataFrame:
    """Rows (word, n, m, set): each two near words meet in at least one set.

    A set's name is a hash; sets whose names collide are searched together, which changes nothing.
    """
    step = F.expr("(m - front - back) div 2").cast("int")  # at least half, rounded down, of one letter less
    length = F.length("word")
    rows = vocabulary.select("word", "n", F.explode(F.array(length, length - 1)).alias("m"))
    rows = rows.select(
        "word", "n", "m", F.xxhash64("m").alias("set"), F.lit(0).alias("front"), F.lit(0).alias("back")
    )
    done, open_rows = None, rows.withColumn("step", step)
    while True:
        open_rows = stored(open_rows)
        large = open_rows.groupBy("set").agg(F.count("*").alias("size"), F.max("step").alias("reach"))
        large = stored(large.filter((F.col("size") > SET_WORDS) & (F.col("reach") > 0)).select("set"))
        settled = open_rows.join(large, "set", "left_anti").select("word", "n", "m", "set")
        done = settled if done is None else done.unionByName(settled)
        if large.isEmpty():
            return done
        # Rows whose step is 0 in a set that others can divide keep that set's name beside the divided ones.
        still = open_rows.join(large, "set")
        done = done.unionByName(still.filter("step < 1").select("word", "n", "m", "set"))
        open_rows = _divided(still.filter("step > 0")).withColumn("step", step)


def _shelved(rows: DataFrame) -> DataFrame:
    """Adds ``shelf``: sets of the same m share an index until it is full."""
    counts = rows.groupBy("m").agg(F.count("*").alias("rows"))
    full = F.greatest(F.lit(1), F.least(F.lit(INDEX_WORDS), F.floor(F.lit(INDEX_LETTERS) / F.col("m"))))
    shelves = counts.select("m", F.ceil(F.col("rows") / full).cast("long").alias("shelves"))
    return rows.join(shelves, "m").withColumn("shelf", F.pmod("set", "shelves")).drop("shelves")


# ------------------------------------------------------------------------------- position index


class PositionIndex:
    """Bitsets per (position, letter) over words given as a matrix of code points padded with 0.

    A position's bitsets are cut from the matrix when the recurrence comes to it, so three positions
    are held at a time, however long the words are.
    """

    def __init__(self, letters: np.ndarray, lengths: np.ndarray):
        self.letters, self.lengths = letters, lengths
        self.blocks = -(-len(lengths) // 64)
        self.alphabet = np.unique(letters[letters > 0])

    def _packed(self, flags: np.ndarray) -> np.ndarray:
        full = np.zeros((*flags.shape[:-1], self.blocks * 64), bool)
        full[..., : flags.shape[-1]] = flags
        return np.packbits(full, axis=-1, bitorder="little").view(np.uint64)

    def at(self, position: int) -> np.ndarray:
        """A bitset per letter of the alphabet, then an empty one for all other letters."""
        out = np.zeros((len(self.alphabet) + 1, self.blocks), np.uint64)
        if 0 <= position < self.letters.shape[1]:
            out[:-1] = self._packed(self.letters[:, position][None, :] == self.alphabet[:, None])
        return out

    def of_length(self, length: int) -> np.ndarray:
        return self._packed(self.lengths == length)

    def near(self, queries: np.ndarray) -> np.ndarray:
        """Bitsets of the words with one edit to each query; all queries have the matrix's width."""
        count, length = queries.shape
        letter = np.minimum(np.searchsorted(self.alphabet, queries), len(self.alphabet) - 1)
        letter = np.where(self.alphabet[letter] == queries, letter, len(self.alphabet))
        zero = np.full((count, self.blocks), ~np.uint64(0))
        replaced, inserted, deleted = (np.zeros_like(zero) for _ in range(3))
        before, now = self.at(-1), self.at(0)
        for i in range(length):
            after = self.at(i + 1)
            behind, here, ahead = (bits[letter[:, i]] for bits in (before, now, after))
            replaced = (replaced & here) | (zero & ~here)
            inserted = (inserted | zero) & ahead
            deleted = (deleted & behind) | zero
            zero &= here
            before, now = now, after
        return (
            (replaced & self.of_length(length))
            | ((inserted | zero) & self.of_length(length + 1))
            | (deleted & self.of_length(length - 1))
        )


def members(bitsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bit of every bit that is set."""
    row, block = np.nonzero(bitsets)
    bits = np.unpackbits(bitsets[row, block][:, None].view(np.uint8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return row[at], block[at] * 64 + bit


#: Queries that are read side by side; bounds what a task holds.
_QUERIES = 2048


def _search(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes of words and of their near words; lengths differ by one at most."""
    lengths = np.array([len(w) for w in words])
    width = int(lengths.max())
    letters = np.zeros((len(words), width), np.uint32)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    inside = np.arange(width)[None, :] < lengths[:, None]
    letters[inside] = points
    index = PositionIndex(letters, lengths)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        for first in range(0, len(rows), _QUERIES):
            part = rows[first : first + _QUERIES]
            query, found = members(index.near(letters[part][:, :length]))
            yield part[query], found


_NEAR = "word string, near string, near_n long"


def near_words(vocabulary: DataFrame) -> DataFrame:
    """Distinct (word, near, near_n): the words of the vocabulary with one edit to each word."""
    target = arrow_schema(_NEAR)

    def search(group: pa.Table) -> pa.Table:
        # A word may lie in several sets of a shelf.
        words, first = np.unique(np.array(group["word"].to_pylist(), object), return_index=True)
        counts = group["n"].to_numpy()[first]
        kept = pa.array(words.tolist(), pa.string())
        parts = [
            pa.table([kept.take(pa.array(a)), kept.take(pa.array(b)), pa.array(counts[b])], schema=target)
            for a, b in _search(words.tolist())
            if len(a)
        ]
        release()
        return pa.concat_tables(parts).combine_chunks() if parts else target.empty_table()

    shelved = _shelved(sets(vocabulary)).select("m", "shelf", "word", "n")
    return shelved.groupBy("m", "shelf").applyInArrow(search, _NEAR).distinct()


# ----------------------------------------------------------------------------------------- forms


def _with_roots(forms: DataFrame, most: int) -> DataFrame:
    """Follows forms to the last. Counts at least double on the way, so it is short; it is halved each time."""
    chain = max(0, int(math.log2(max(1, most) / LEAST_COUNT))) if most > LEAST_COUNT else 0
    roots = stored(forms.select("word", F.coalesce("form", "word").alias("root")))
    for _ in range(max(1, chain).bit_length()):
        next_ = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = stored(roots.join(next_, "root").select("word", F.col("further").alias("root")))
    return forms.join(roots, "word")


def variants(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """Per word its count ``n``, near words ``n_near``, ``form`` with ``form_n``, and ``root``."""
    counted = count_words(docs, key, text, least_letters)
    vocabulary = stored(counted.filter(F.col("n") >= least_count))
    # The greatest count first, then the smallest word.
    order = F.struct((-F.col("near_n")).alias("rest"), "near")
    near = near_words(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), F.min(order).alias("best"))
    accepted = -F.col("best.rest") >= FACTOR * F.col("n")
    forms = stored(
        vocabulary.join(near, "word", "left").select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(accepted, F.col("best.near")).alias("form"),
            F.when(accepted, -F.col("best.rest")).alias("form_n"),
        )
    )
    most = forms.agg(F.max("n")).first()[0] or 0
    return _with_roots(forms, most).select("word", "form", "root", "n", "n_near", "form_n")
