"""Personal data: high-recall candidates, boosted trees, calibrated thresholds.

Base matches (e-mail, IPv4, payment card, phone) are found by format and check digits and always
kept. Beside them, generators propose many overlapping spans: loose forms of the base kinds,
assignments, tokens that mix letters and digits, and the words around all of these. Boosted trees
on features of format and context score them; calibrated thresholds select what is added. Added
spans do not overlap one another; only secrets may overlap base spans, and those that context does
not select may only hold them whole. Values, names and words run to their end, however long.

The trees learn from the corpus itself, each from evidence that its own features cannot see:

* The *format* trees see a value alone, never the words around it. A value named ``password`` or
  the like is an example of a secret whatever it looks like, so that they learn what secrets look
  like and find those that nothing names. Keys of a known form and base matches are examples too;
  a phone number also without its plus and country code, a card, address or e-mail also damaged, as
  an example of what is not personal. All other candidates count as unlabelled.
* The *context* trees see the name, sign, quotes and borders, never the value. Their examples are
  the values that the format trees select, so a name or place counts as far as secrets follow it.

Thresholds come from candidates that fitting did not see. A format threshold lets through
``1 - MISSED`` of the labelled ones (as spies among the unlabelled) and at most ``STRAY`` of the
unlabelled ones; a context threshold must agree with the format trees in ``AGREE`` of all cases.
Either selects.

Equal candidates are collapsed and weigh by the logarithm of their number. All of them are fitted and
calibrate thresholds: trees see no more of a value than the bins of its features, so Spark adds up the
candidates of equal bins (*cells*) and the driver gets cells. Where there would be more than ``CELLS``,
bins are merged until there are not; no candidate is left out. The labelled and the unlabelled
ones each weigh like ``SIDE`` candidates at most, whatever their number.

Offsets are code points, ends exclusive. Defined results: a null or empty text has no spans;
repeated rows and null ids are handled row by row; further columns pass through ``redact`` and are
left out elsewhere; where no labelled and unlabelled candidates exist, only base spans are found.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import boosted_trees
from shelfcast.llm.tables import map_batches, stored

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
#: Cells from which bins are merged; with two bins per feature but the kind there are under a million.
CELLS = 400_000
#: Candidates that the labelled and the unlabelled ones weigh like at most, and quantiles of either
#: that bound the bins of a feature in cells; trees choose their cuts among 31 quantiles of all.
SIDE, BINS = 20_000, 64
#: Labels of candidates: unlabelled, labelled, known not to be personal.
FREE, KNOWN, OTHER = 0, 1, 2
#: Weights are added up as whole numbers, so that sums do not depend on the order of rows.
_UNIT = 1 << 20
#: Share of held-out labelled candidates that a format threshold may miss, share of all held-out
#: unlabelled ones that it may let through, and how many labelled ones a kind needs.
MISSED, STRAY, LEAST = 0.05, 0.01, 10
#: Share of held-out candidates selected by context that the format trees select as well.
AGREE = 0.9
#: Lowest threshold, and that of a kind with fewer labelled candidates than ``LEAST``, or of all
#: kinds where fewer than ``1 / STRAY`` unlabelled ones are held out.
UNCALIBRATED = 0.5

_TRIGGER = re.compile("[0-9@=]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never begins inside a run of digits: one that begins at the run's start fails or takes
# the whole run, so looking behind only saves time on very long runs.
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Words with a digit, @ or =; tried at a word's start only, so a long word without any is read once.
_TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@=]*+[0-9@=][^\x20\x09-\x0D]*")
# Tried where a run of name characters begins, so a long run is read once.
_NAME = re.compile(r"(?<![A-Za-z0-9_.-])[0-9.-]*+([A-Za-z_][A-Za-z0-9_.-]++)\x20?[=:]")
# Possessive and without an upper bound: a value is taken whole or, without its closing quote, not at all.
_VALUE = r"\x20?(\"[^\"\n]{4,}+\"|'[^'\n]{4,}+'|[^\x20\x09-\x0D\"']{4,}+)"
_ASSIGNED = re.compile(_NAME.pattern + _VALUE)
_LOOSE_NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().-]?[0-9]){5,}+")
# Numbers in two to four groups, the first perhaps in parentheses.
_LOOSE_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])")
_COUNTRY = re.compile(r"\+[0-9]{1,3}[\x20.-]*(?=[(0-9])")
_KEYWORD = re.compile(r"(?i)(pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth)\Z")
_KNOWN_KEY = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}\Z|(?:gh[pousr]_|sk-|xox[abp]-)[A-Za-z0-9-]{16,}\Z")
_KEY_STARTS = ("AKIA", "ASIA")
_KEY_LIKE = re.compile(r"(?<![A-Za-z0-9])[A-Z0-9]{16,}+(?![A-Za-z0-9])")
#: Characters of context on either side.
_CONTEXT = 24
_HEX = "0123456789abcdef"
# A letter next to a digit.
_TURN = re.compile(r"(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield "email", start, done
        # A failed address leaves its characters to later ones.
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Validated matches, leftmost and without overlap within a kind, by start and kind."""
    if not _TRIGGER.search(text):
        return []
    out = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=order)


def order(span) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


def candidates(text: str) -> list[Span]:
    """Overlapping proposals; what they hold need not be personal."""
    if not (_TRIGGER.search(text) or any(p in text for p in _KEY_STARTS)):
        return []
    out: set[Span] = set()
    for m in _KEY_LIKE.finditer(text):
        out.add(("secret", *m.span()))
    for m in _ASSIGNED.finditer(text):
        out.add(("secret", m.start(1), m.end()))
        if _KEYWORD.search(m[1]):
            continue
        # A long value, such as an address, may hold assignments of its own.
        at, last = m.span(2)
        while name := _NAME.search(text, at, last):
            inner = _ASSIGNED.match(text, name.start(), last) if _KEYWORD.search(name[1]) else None
            if inner:
                out.add(("secret", inner.start(1), inner.end()))
            at = inner.end() if inner else name.end()
    for m in _LOOSE_NUMBER.finditer(text):
        kind = "phone" if m[0][0] in "+(" else "ip" if m[0].count(".") == 3 else "card"
        out.add((kind, *m.span()))
    for m in _LOOSE_PHONE.finditer(text):
        out.add(("phone", *m.span()))
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        core = m[0].strip(".,;:!?\"'()[]{}<>")
        begin = start + m[0].find(core) if core else start
        if "@" in core:
            out.add(("email", begin, begin + len(core)))
        elif len(core) >= 6:
            out.add(("secret", begin, begin + len(core)))
        # The neighbouring words: proposals of ordinary text.
        before = text[max(0, start - 40) : start].split()
        after = text[end : end + 40].split()
        if len(before) > 1 and len(before[-1]) >= 5:
            at = text.rfind(before[-1], max(0, start - 40), start)
            out.add(("secret", at, at + len(before[-1])))
        if len(after) > 1 and len(after[0]) >= 5:
            at = text.find(after[0], end, end + 40)
            out.add(("secret", at, at + len(after[0])))
    return list(out)


def assigned(value: str) -> tuple[str, str]:
    """Name and value of an assignment; of anything else no name and all of it."""
    m = _ASSIGNED.fullmatch(value)
    if not m:
        return "", value
    return m[1], m[2][1:-1] if m[2][0] in "\"'" else m[2]


def evidence(text: str, span: Span, base: set[Span]) -> int:
    """2: certain by format, 1: a secret by its name, 0: nothing is known."""
    kind, start, end = span
    if span in base:
        return 2
    if kind != "secret":
        return 0
    value = text[start:end]
    if _KNOWN_KEY.match(value):
        return 2
    return int(bool(_KEYWORD.search(assigned(value)[0])))


def format_features(kind: str, value: str) -> list[float]:
    """What a value looks like; neither its name nor its surroundings."""
    value = assigned(value)[1] if kind == "secret" else value
    n = len(value)
    # Values may be long: characters are counted once, the rest works on the counts.
    counts = Counter(value)
    digits = sum(k for c, k in counts.items() if "0" <= c <= "9")
    lower = sum(k for c, k in counts.items() if "a" <= c <= "z")
    upper = sum(k for c, k in counts.items() if "A" <= c <= "Z")
    entropy = -sum(k / n * math.log2(k / n) for k in counts.values())
    # Check digits and groups say nothing of a secret.
    number = _digits(value) if 14 <= digits <= 19 and kind != "secret" else ""
    groups = value.split(".") if counts["."] == 3 and kind != "secret" else []
    byte_groups = len(groups) == 4 and all(g.isascii() and g.isdigit() and len(g) <= 3 and int(g) <= 255 for g in groups)
    host = value[value.find("@") + 1 :] if counts["@"] else ""
    return [
        float(KINDS.index(kind)),
        float(n),
        digits / n,
        lower / n,
        upper / n,
        1 - (digits + lower + upper) / n,
        entropy,
        sum(counts[c] for c in _HEX) / n,
        len(_TURN.findall(value)) / n,
        float(counts["@"]),
        float("." in host),
        float(counts["."]),
        float(counts["("] + counts[")"] + counts["-"] + counts[" "]),
        float(bool(number and _luhn(number))),
        float(digits if kind != "secret" else 0),
        float(byte_groups),
    ]


def context_features(text: str, span: Span) -> list[float]:
    """What names and surrounds a value; nothing of the value itself."""
    _, start, end = span
    name, value = assigned(text[start:end])
    sign = text[start + len(name) : end].lstrip(" ")[:1] if name else ""
    before, after = text[max(0, start - _CONTEXT) : start], text[end : end + _CONTEXT]
    last_word = (before.split() or [""])[-1]
    return [
        float(bool(name)),
        float(bool(_KEYWORD.search(name))),
        float(min(len(name), _CONTEXT)),
        float(sign == "="),
        float(bool(name) and text[end - 1] in "\"'" and not value.endswith(text[end - 1])),
        float(bool(_KEYWORD.search(last_word.strip(":=\"'")))),
        float(last_word[-1:] in ("=", ":")),
        float(before[-1:].isspace() or not before),
        float(after[:1].isspace() or not after),
    ]


def altered(span: Span, value: str) -> list[tuple[str, int]]:
    """Forms of a base match with their evidence: weakened (2) or damaged (-1)."""
    kind = span[0]
    if kind == "phone":
        bare = value[m.end() :] if (m := _COUNTRY.match(value)) else ""
        return [(bare, 2)] if len(_digits(bare)) >= 7 else []
    if kind == "card":
        return [(value[:-1] + str((int(value[-1]) + 1) % 10), -1)]
    if kind == "ip":
        first, rest = value.split(".", 1)
        return [(f"{int(first[-3:]) + 256}.{rest}", -1)]
    return [(value[: value.index("@") + 1] + value[value.index("@") + 1 :].replace(".", ""), -1)]


def examples(text: str) -> Iterator[tuple[list[float], list[float], int]]:
    """Format, context and evidence of every candidate; -1 is known not to be personal.

    Candidates that overlap one with evidence are left out: a part of a secret is no counterexample.
    """
    found = candidates(text)
    base = set(base_spans(text))
    told = {s: evidence(text, s, base) for s in {*found, *base}}
    known = _Taken([s for s, e in told.items() if e])
    for span, e in told.items():
        kind, start, end = span
        if e or not known.meets(start, end):
            yield format_features(kind, text[start:end]), context_features(text, span), e
    for span in base:
        for value, e in altered(span, text[span[1] : span[2]]):
            yield format_features(span[0], value), context_features(text, span), e


@dataclass(frozen=True)
class Model:
    form: boosted_trees.Trees | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    place: boosted_trees.Trees | None = None
    place_threshold: float = 2.0

    def select(self, text: str, spans: list[Span]) -> list[tuple[bool, Span]]:
        """Selected spans, each with whether its context selects it."""
        if self.form is None or not spans:
            return []
        form = self.form.probability(np.array([format_features(s[0], text[s[1] : s[2]]) for s in spans]))
        least = np.array([self.thresholds.get(s[0], 2.0) for s in spans])
        placed = np.zeros(len(spans), bool)
        if self.place is not None:
            place = self.place.probability(np.array([context_features(text, s) for s in spans]))
            placed = (place >= self.place_threshold) & np.array([s[0] == "secret" for s in spans])
        return [(bool(p), s) for p, ok, s in zip(placed, placed | (form >= least), spans, strict=True) if ok]


class _Taken:
    """Ranges that were taken; asking for and adding a range cost no scan over the others."""

    def __init__(self, spans: list[Span] = ()):
        known = sorted((start, end) for _, start, end in spans)
        self._starts = [start for start, _ in known]
        # The furthest end so far, as given ranges may overlap.
        self._ends = list(accumulate((end for _, end in known), max))

    def meets(self, start: int, end: int) -> bool:
        at = bisect_left(self._starts, end)
        return at > 0 and self._ends[at - 1] > start

    def add(self, start: int, end: int) -> None:
        """Adds a range that meets none of the others."""
        at = bisect_left(self._starts, start)
        self._starts.insert(at, start)
        self._ends.insert(at, end)


def _select(text: str, base: list[Span], model: Model) -> list[Span]:
    given = set(base)
    proposed = [s for s in candidates(text) if s not in given] if model.form is not None else []
    # Of spans that overlap, those named by their context go first, then the longest.
    ranked = sorted((not placed, s[1] - s[2], s[1], s) for placed, s in model.select(text, proposed))
    if not ranked:
        return base
    added: list[Span] = []
    of_base, of_added = _Taken(base), _Taken()
    for unnamed, *_, span in ranked:
        kind, start, end = span
        # What a base span begins or ends is that span; a secret may hold one, a named one be one.
        ends = of_base.meets(start, start + 1) or of_base.meets(end - 1, end)
        free = not (unnamed and ends) if kind == "secret" else not of_base.meets(start, end)
        if free and not of_added.meets(start, end):
            added.append(span)
            of_added.add(start, end)
    return sorted([*base, *added], key=order)


def find(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, of one text."""
    base = base_spans(text)
    return base, _select(text, base, model)


def _spied(scores: np.ndarray, weights: np.ndarray, counts: np.ndarray, known: np.ndarray, of_all: float) -> float:
    """Lowest score that lets through enough labelled and few enough unlabelled candidates.

    ``counts`` are the candidates of a cell, ``of_all`` the weight of the unlabelled ones of all kinds.
    """
    up = np.argsort(scores[known], kind="stable")
    upto = np.cumsum(counts[known][up])
    lowest = UNCALIBRATED
    if len(upto) and upto[-1] >= LEAST:
        missed = np.searchsorted(upto, int(MISSED * upto[-1]), "right")
        lowest = max(UNCALIBRATED, float(scores[known][up][missed]))
    rest = np.argsort(-scores[~known], kind="stable")
    through = np.cumsum(weights[~known][rest])
    over = np.flatnonzero(through > STRAY * of_all)
    if len(over):
        # All of one score go or stay together.
        lowest = max(lowest, float(np.nextafter(scores[~known][rest][over[0]], 2.0)))
    return lowest


def _agreed(scores: np.ndarray, weights: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> float:
    """Lowest score from which candidates are right often enough; 2.0 selects none."""
    if (labels * counts).sum() < LEAST:
        return UNCALIBRATED
    down = np.argsort(-scores, kind="stable")
    right = np.cumsum((labels * weights)[down]) / np.cumsum(weights[down])
    good = np.flatnonzero((right >= AGREE) & np.append(np.diff(scores[down]) != 0, True))
    return max(UNCALIBRATED, float(scores[down][good[-1]])) if len(good) else 2.0


def _edges(distinct: DataFrame) -> list[np.ndarray]:
    """Upper ends of the bins of each format feature: quantiles of labelled and of unlabelled candidates."""
    places = [i / BINS for i in range(BINS + 1)]
    width = len(format_features("email", "-"))
    found = [set() for _ in range(width)]
    for which in (F.col("told") > 0, F.col("told") <= 0):
        features = distinct.where(which).select(*[F.col("form")[j].alias(f"f{j}") for j in range(width)])
        for own, values in zip(found, features.approxQuantile(features.columns, places, 0.002), strict=True):
            own.update(values)
    return [np.array(sorted(own)) for own in found]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _cells(distinct: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """Candidates of equal bins, label and side: their number and weight."""

    def binned(batch: pa.RecordBatch):
        form = _matrix(batch.column(0))
        bins = [np.searchsorted(e, form[:, j], "left") for j, e in enumerate(edges)]
        yield {
            "cell": [row.tobytes() for row in np.stack(bins, axis=1).astype(np.uint8)],
            "label": batch.column(1), "apart": batch.column(2), "w": batch.column(3),
        }

    label = F.when(F.col("told") > 0, KNOWN).when(F.col("told") == 0, FREE).otherwise(OTHER).alias("label")
    rows = map_batches(distinct.select("form", label, "apart", "w"), binned, "cell binary, label int, apart int, w long")
    return rows.groupBy("cell", "label", "apart").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"))


def _all_cells(distinct: DataFrame) -> tuple[pa.Table, list[np.ndarray]]:
    """All cells, of bins merged until no more than ``CELLS`` are left, and the ends of the bins."""
    edges = _edges(distinct)
    while True:
        cells = stored(_cells(distinct, edges))
        if cells.count() <= CELLS or max(map(len, edges[1:])) <= 1:
            return cells.toArrow(), edges
        edges = edges[:1] + [e[1::2] if len(e) > 1 else e for e in edges[1:]]


def _place_cells(distinct: DataFrame, form: boosted_trees.Trees, least: float) -> pa.Table:
    """Secrets of equal context, which has few values, by whether the format trees select them."""

    def scored(batch: pa.RecordBatch):
        forms = _matrix(batch.column(0))
        yield {
            "place": batch.column(1), "apart": batch.column(2), "w": batch.column(3),
            "named": (form.probability(forms) >= least).astype(np.int32),
        }

    secrets = distinct.where(F.col("form")[0] == float(KINDS.index("secret"))).select("form", "place", "apart", "w")
    rows = map_batches(secrets, scored, "place array<double>, apart int, w long, named int")
    return rows.groupBy("place", "apart", "named").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).toArrow()


def _cuts(x: np.ndarray, weights: np.ndarray, parts: int = 32) -> list[np.ndarray]:
    """Weighted quantiles of each feature."""
    cuts = []
    for column in x.T:
        up = np.argsort(column, kind="stable")
        upto = np.cumsum(weights[up])
        at = np.searchsorted(upto, upto[-1] * np.arange(1, parts) / parts)
        cuts.append(np.unique(column[up][np.minimum(at, len(up) - 1)]))
    return cuts


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy() for c in names]


def fit(docs: DataFrame, sample: int | None = None, text: str = "text") -> Model:
    """Learns from all distinct candidates of the corpus, or from at most ``sample`` where that is given."""

    def propose(batch: pa.RecordBatch):
        seen: Counter = Counter()
        for value in batch.column(0):
            for form, place, told in examples(value.as_py() or ""):
                seen[tuple(form), tuple(place), told] += 1
        forms, places, tolds = zip(*seen, strict=True) if seen else ((), (), ())
        yield {"form": list(forms), "place": list(places), "told": list(tolds), "n": list(seen.values())}

    proposed = map_batches(
        docs.select(docs[text].alias("text")), propose, "form array<double>, place array<double>, told int, n long"
    )
    # Equal formats fall on one side, so calibration sees none that fitting saw.
    side = F.pmod(F.xxhash64("form"), F.lit(2)).cast("int")
    weight = F.round((1 + F.log2(F.col("n"))) * _UNIT).cast("long")
    distinct = stored(
        proposed.groupBy("form", "place", "told").agg(F.sum("n").alias("n"))
        .withColumns({"apart": side, "w": weight})
    )
    if sample is not None:
        draw = F.xxhash64("form", "place")
        halves = [
            distinct.where(which).orderBy(draw, "form", "place", "told").limit(sample // 2)
            for which in (F.col("told") != 0, F.col("told") == 0)
        ]
        distinct = stored(halves[0].unionByName(halves[1]))
    cells, edges = _all_cells(distinct)
    cells = cells.sort_by([(c, "ascending") for c in ("cell", "label", "apart")])
    label, sides, weights, counts = _numbers(cells, "label", "apart", "w", "n")
    weights, apart, known, free = weights / _UNIT, sides == 1, label == KNOWN, label == FREE
    # A share of STRAY cannot be seen among few candidates: those are all fitted and none calibrated.
    held_out = counts[free & apart].sum() >= 1 / STRAY
    apart &= held_out
    if not (known & ~apart).any() or not (~known & ~apart).any():
        return Model()
    bins = np.frombuffer(b"".join(cells.column("cell").to_pylist()), np.uint8).reshape(len(label), -1)
    # A cell stands at the upper ends of its bins, the last bins beyond all ends.
    x = np.stack([np.append(e, np.inf)[bins[:, j]] for j, e in enumerate(edges)], axis=1)
    kinds = np.append(edges[0], KINDS.index("secret"))[bins[:, 0]]
    balance = lambda those: np.where(those, min(1.0, SIDE / max(1, counts[those].sum())), 0.0)
    share = balance(label != FREE) + balance(free)
    fitted, cuts = weights * share, _cuts(x[~apart], (counts * share)[~apart])
    form = boosted_trees.fit(x[~apart], known[~apart].astype(float), fitted[~apart], edges=cuts)
    scores = form.probability(x)
    thresholds = {}
    of_all = float(weights[apart & free].sum())
    for i, kind in enumerate(KINDS):
        own = apart & (kinds == i) & (known | free)
        if (known & ~apart & (kinds == i)).any():
            thresholds[kind] = _spied(scores[own], weights[own], counts[own], known[own], of_all)
    # Context: secrets by format, whatever names them.
    places = _place_cells(distinct, form, thresholds.get("secret", 2.0))
    if not len(places):
        return Model(form, thresholds)
    sides, weights, counts, named = _numbers(places, "apart", "w", "n", "named")
    weights, check = weights / _UNIT, (sides == 1) & held_out
    if not 0 < named[~check].sum() < (~check).sum():
        return Model(form, thresholds)
    z = np.array(places.column("place").to_pylist())
    ordered = np.lexsort((*z.T, sides, named))
    z, weights, counts, named, check = z[ordered], weights[ordered], counts[ordered], named[ordered], check[ordered]
    fitted = weights * min(1.0, 2 * SIDE / counts.sum())
    cuts = _cuts(z[~check], counts[~check].astype(float))
    place = boosted_trees.fit(z[~check], named[~check].astype(float), fitted[~check], edges=cuts)
    agreed = _agreed(place.probability(z[check]), weights[check], counts[check], named[check].astype(float)) if held_out else UNCALIBRATED
    return Model(form, thresholds, place, agreed)


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def detect(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, base spans and all spans."""

    def run(batch: pa.RecordBatch):
        found = [find(t.as_py() or "", model) for t in batch.column(1)]
        as_rows = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]
        yield {
            "doc_id": batch.column(0),
            "base": [as_rows(b) for b, _ in found],
            "spans": [as_rows(a) for _, a in found],
        }

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    return map_batches(rows, run, f"doc_id long, base {_SPANS}, spans {_SPANS}")


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; spans that overlap become one."""
    out, done = [], 0
    for i, (kind, start, end) in enumerate(spans):
        if start >= done or i == 0:
            out.append(text[done:start] + f"[{kind.upper()}]")
        done = max(done, end)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns, the text redacted; a null text stays null."""
    names = docs.columns
    at = names.index(text)
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def run(batch: pa.RecordBatch):
        columns = {f"c{i}": batch.column(i) for i in range(len(names))}
        texts = [t.as_py() for t in batch.column(at)]
        columns[f"c{at}"] = [None if t is None else masked(t, find(t, model)[1]) for t in texts]
        yield columns

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema.fields)
    return map_batches(numbered, run, schema).toDF(*names)
