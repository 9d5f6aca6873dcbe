"""Rule bitmask ledger: every rule is evaluated once, policies and ablations read its bits.

``ledger`` measures each text, evaluates all rules and stores one row per document: the
measurements and ``failed_rules``, a bit for every rule that the text fails. A policy is a
named, versioned set of rules; applying one, or asking what a rule costs, is arithmetic on the
bits and never reads a text again.

Defined results: a null or empty text has no words, all measurements 0. Rows with a null or
repeated ``doc_id`` are measured row by row. Further input columns, whatever their names, are
left out of the ledger. An empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import blocks
from shelfcast.llm.tables import map_batches

#: Words of a window in which repetition is looked for.
REPEAT_WINDOW = 8
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper",
    "n_echo_words",
)


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for a text that breaks the rule, given its measurements."""

    name: str
    fails: Column


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]


def default_rules() -> list[Rule]:
    n, col = F.col("n_words"), F.col
    return [
        Rule("too_few_words", n < 20),
        Rule("repeated_windows", 100 * col("n_repeat_words") > 30 * n),
        Rule("repeated_lines", 100 * col("n_dup_lines") > 50 * col("n_lines")),
        Rule("symbols", 100 * col("n_symbols") > 10 * n),
        Rule("short_words", col("word_chars") < 2 * n),
        Rule("long_words", col("word_chars") > 25 * n),
        Rule("echoed_words", 100 * col("n_echo_words") > 30 * n),
        Rule("upper_case", 100 * col("n_upper") > 60 * col("word_chars")),
    ]


BASE = Policy("base", 1, ("too_few_words", "repeated_windows"))
STRICT = Policy(
    "strict",
    1,
    BASE.rules + ("repeated_lines", "symbols", "short_words", "long_words", "echoed_words", "upper_case"),
)


def _measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    words = blocks.Words(data, offsets)
    letters = (data & 0xC0) != 0x80
    of_word = blocks.owners(words.bounds)
    bounds = words.bounds
    # Windows of one document each, told apart between documents by the document's number.
    each = words.hashes()
    hashed = blocks.windows(each, REPEAT_WINDOW)
    inside = of_word[: len(hashed)] == of_word[REPEAT_WINDOW - 1 :] if len(hashed) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    keys = hashed[at] ^ blocks.mix(of_word[at].astype(np.uint64))
    twice, _ = blocks.repeated(keys)
    covered = blocks.cover(at[twice], REPEAT_WINDOW, len(of_word))
    echoed = np.zeros(len(each), bool)
    echoed[1:] = (each[1:] == each[:-1]) & (of_word[1:] == of_word[:-1])
    # Lines end at \n and at the end of a document.
    breaks = np.flatnonzero(data == 10)
    line_ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    line_starts = np.sort(np.concatenate([breaks + 1, offsets[:-1]]))
    filled = np.searchsorted(words.starts, line_ends) > np.searchsorted(words.starts, line_starts)
    line_starts, line_ends = line_starts[filled], line_ends[filled]
    of_line = np.searchsorted(offsets, line_starts, "right") - 1
    line_bounds = np.searchsorted(of_line, np.arange(len(offsets)))
    line_keys = blocks.span_hashes(data, line_starts, line_ends) ^ blocks.mix(of_line.astype(np.uint64))
    _, later = blocks.repeated(line_keys)
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS.encode())] = True
    return {
        "n_words": np.diff(bounds),
        "word_chars": blocks.per_document(words.inside & letters, offsets),
        "n_symbols": blocks.per_document(symbols[data], offsets),
        "n_lines": np.diff(line_bounds),
        "n_dup_lines": blocks.per_document(later, line_bounds),
        "n_repeat_words": blocks.per_document(covered, bounds),
        "n_upper": blocks.per_document((data >= 65) & (data <= 90), offsets),
        "n_echo_words": blocks.per_document(echoed, bounds),
    }


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with their columns, which become ``c0``, ``c1`` and so on, and the measurements."""
    at = docs.columns.index(text)
    given = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def measure(batch: pa.RecordBatch):
        for first, last, data, offsets in blocks.text_blocks(batch.column(at)):
            own = {f"c{i}": batch.column(i)[first:last] for i in range(batch.num_columns)}
            yield {**own, **_measure(data, offsets)}

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields]
    return map_batches(given, measure, ", ".join([*fields, *(f"{m} long" for m in MEASURES)]))


def failed(rules: Sequence[Rule]) -> Column:
    """The bits of the rules that a measured row fails, rule i at bit i."""
    if len(rules) > 63:
        raise ValueError("a ledger holds at most 63 rules")
    none = F.lit(0).cast("long")
    bits = none
    for i, rule in enumerate(rules):
        bits = bits + F.when(rule.fails, F.lit(1 << i).cast("long")).otherwise(none)
    return bits


def ledger(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: id, measurements and ``failed_rules``."""
    rules = default_rules() if rules is None else rules
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    ids = _without_text(rows)
    return ids.withColumn("failed_rules", failed(rules))


def _without_text(rows: DataFrame) -> DataFrame:
    def measure(batch: pa.RecordBatch):
        for first, last, data, offsets in blocks.text_blocks(batch.column(1)):
            yield {"doc_id": batch.column(0)[first:last], **_measure(data, offsets)}

    return map_batches(rows, measure, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))


def keep_passing(docs: DataFrame, policy: Policy, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """The rows, with their columns, that a policy keeps; nothing is shuffled."""
    rules = default_rules() if rules is None else rules
    kept = measured(docs, text).withColumn("failed_rules", failed(rules)).where(passes(policy, rules))
    return kept.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def mask(policy: Policy, rules: Sequence[Rule] | None = None) -> int:
    names = [r.name for r in (default_rules() if rules is None else rules)]
    return sum(1 << names.index(name) for name in policy.rules)


def passes(policy: Policy, rules: Sequence[Rule] | None = None) -> Column:
    return F.col("failed_rules").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def apply_policies(book: DataFrame, policies: Sequence[Policy], rules: Sequence[Rule] | None = None) -> DataFrame:
    """A column ``<name>_v<version>`` per policy: whether the document stays."""
    return book.withColumns({f"{p.name}_v{p.version}": passes(p, rules) for p in policies})


def ablations(book: DataFrame, policy: Policy, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Per rule of the policy: documents failing it, and documents that only it rejects.

    Rows first collapse to one per bit pattern, so the rules are compared on few rows.
    """
    rules = default_rules() if rules is None else rules
    whole = F.lit(mask(policy, rules)).cast("long")
    names = [r.name for r in rules]
    patterns = book.groupBy(F.col("failed_rules").bitwiseAND(whole).alias("bits")).agg(
        F.count("*").alias("n")
    )
    each = F.explode(
        F.array(*[
            F.struct(F.lit(name).alias("rule"), F.lit(1 << names.index(name)).cast("long").alias("bit"))
            for name in policy.rules
        ])
    )
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (
        patterns.select("bits", "n", each.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))), F.lit(0)).alias("n_only"),
        )
    )

