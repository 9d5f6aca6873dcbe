"""Byte-pair encoding as a streaming transducer, and incremental decoding.

Encoding. The symbols of a word are its bytes; the last one carries the end-of-word mark. With
one merge per token, a sequence of tokens is the encoding of its text exactly when every two
neighbours are the encoding of their own joint text, and every prefix of a word has exactly one
last token. So the transducer keeps, for each position, the last token of that prefix and where
that token starts. A later token reaches back over at most ``lookahead`` symbols (the longest
token of the merge list, computed once), so only the paths that end in that window can still
grow. Where they agree, tokens are stable and leave at once: memory is bounded by the window and
the unstable tail, whatever the length of the word.

Decoding. ``TextDecoder`` takes ids one at a time and gives out text as soon as its bytes form
whole characters; bytes that no character can hold become U+FFFD. Its mode ``joined`` gives what a
vocabulary without a decoder is read back as, the tokens with spaces between.

Every word goes through the transducer and every id through the decoder. Workers remember the ids of
recent words and runs, so equal words are streamed once.

``Codec.encode`` agrees with the tokenizers library on the same vocabulary file (NFC, runs of
white space to one space, lower case, split by pattern, special tokens found in the raw text).

Defined results: a null or empty text has no tokens and decodes to the empty text; a null id stays
null; repeated rows are encoded row by row; an empty table gives an empty table.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import sys
import types
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm.tables import map_batches

#: Encoded words, and runs of text between spaces, that a worker remembers; recently used ones
#: are kept for twice as many. About 250 and 350 bytes each.
WORDS, RUNS = 300_000, 150_000
#: Fixed value: how the vocabulary's pre-tokenizer splits normalized text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters that Python counts as white space and the normalizer does not.
_SPACES = regex.compile(r"[\t-\r \x85\p{Z}]+")
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in out:
            out[b] = chr(spare)
            spare += 1
    return [out[b] for b in range(256)]


class Memory(dict):
    """Remembers a bounded number of results; what is used again outlives what is not."""

    def __init__(self, size: int, make):
        super().__init__()
        self._size, self._make, self._older = size, make, {}

    def __missing__(self, key):
        found = self._older.get(key)
        if found is None:
            found = self._make(key)
        if len(self) >= self._size:
            self._older = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = found
        return found


class Codec:
    """One vocabulary: ids of byte-level symbols, merges in order of rank, special tokens."""

    def __init__(self, spec: dict, words: int = WORDS, runs: int = RUNS):
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.written = {str(i): t for i, t in self.names.items()}
        self.symbols = byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(self.symbols)}
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        if len({a + b for a, b in merges}) != len(merges):
            raise ValueError("two merges make one token; the transducer needs one each")
        # By id: rank of the merge that makes a token, or -1, and its two parts.
        self.base = max(self.vocab.values()) + 1
        self.made, self.left, self.right = [-1] * self.base, [0] * self.base, [0] * self.base
        self.rank: dict[int, int] = {}
        for i, (first, second) in enumerate(merges):
            x, y, whole = (self.vocab[t] for t in (first, second, first + second))
            self.rank[x * self.base + y] = i
            self.made[whole], self.left[whole], self.right[whole] = i, x, y
        self.split = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.lookahead = max(map(self._size, self.vocab), default=1)
        # All ends of tokens: no token ends in a piece that is missing here. -1 where it is no token.
        self.tails: dict[str, int] = {}
        for token, number in self.vocab.items():
            for i in range(1, self._size(token)):
                self.tails.setdefault(token[i:], -1)
            self.tails[token] = number
        self._agree: dict[int, dict[int, bool]] = {}
        self._pairs = 0
        self._words = Memory(words, self._word)
        self.runs = Memory(runs, self._run)

    def _size(self, token: str) -> int:
        return len(token) - len(self.end) if self.end and token.endswith(self.end) and token != self.end else len(token)

    def _apart(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart: no merge across their border comes before their own."""
        # Undo the latest merges first; a border merge applies if it ranks before what it undoes.
        rank, made, base = self.rank.get, self.made, self.base
        limit = len(self.rank)
        while True:
            if rank(left * base + right, limit) < limit:
                return False
            of_left, of_right = made[left], made[right]
            if of_left < 0 and of_right < 0:
                return True
            # Of equal ranks the left occurrence was merged first, so the right is undone first.
            if of_left > of_right:
                limit, left = of_left, self.right[left]
            else:
                limit, right = of_right + 1, self.left[right]

    def stream(self, symbols: Iterable[str]) -> Iterator[int]:
        """Token ids of one word, each as soon as it is stable; the last symbol ends the word."""
        tails, agree, window = self.tails.get, self._agree, self.lookahead
        if self._pairs > 2 * WORDS:
            agree.clear()
            self._pairs = 0
        # Last token of each prefix and where it starts: -1 at the front, -2 where no token can end.
        last, starts = [-1], [-1]
        text, n = "", 0  # what precedes has been given out
        it = iter(symbols)
        ahead = next(it, None)
        while ahead is not None:
            symbol, ahead = ahead, next(it, None)
            text += symbol if ahead is not None else symbol + self.end
            n += 1
            found, at = -1, -2
            # Only one token fits, so the shortest candidates come first.
            for start in range(n - 1, -1, -1):
                token = tails(text[start:])
                if token is None:
                    break
                if token < 0 or starts[start] == -2:
                    continue
                before = last[start]
                if before >= 0:
                    known = agree.get(before)
                    if known is None:
                        known = agree[before] = {}
                    apart = known.get(token)
                    if apart is None:
                        apart = known[token] = self._apart(before, token)
                        self._pairs += 1
                    if not apart:
                        continue
                found, at = token, start
                break
            last.append(found)
            starts.append(at)
            if n >= 4 * window:
                cut = self._stable(starts, n, window)
                if cut:
                    yield from self._path(last, starts, cut)
                    text, last, n = text[cut:], last[cut:], n - cut
                    starts = [s - cut if s >= 0 else s for s in starts[cut:]]
                    starts[0] = -1
        if starts[n] == -2:
            raise ValueError(f"no encoding of {text!r}")
        yield from self._path(last, starts, n)

    @staticmethod
    def _path(last: list[int], starts: list[int], end: int) -> list[int]:
        """Tokens up to a position, found from its end."""
        out = []
        while end > 0:
            out.append(last[end])
            end = starts[end]
        return out[::-1]

    @staticmethod
    def _stable(starts: list[int], n: int, window: int) -> int:
        """Where the tokens end that are common to all paths which later tokens can continue."""
        ends = {p for p in range(n - window + 1, n + 1) if starts[p] != -2}
        while len(ends) > 1:
            far = max(ends)
            ends.discard(far)
            if starts[far] >= 0:
                ends.add(starts[far])
        return ends.pop()

    def normalize(self, text: str) -> str:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if not text.isalpha():
            text = _SPACES.sub(" ", text)
        # Lower case by character: no special form of a final sigma.
        return text.replace("Σ", "σ").lower()

    def _word(self, word: str) -> tuple[int, ...]:
        symbols = word if word.isascii() and word.isprintable() else [self.symbols[b] for b in word.encode()]
        return tuple(self.stream(symbols))

    def _split(self, text: str) -> list[str]:
        """Normalized words and marks of a text without special tokens."""
        # White space only parts words, so plain ASCII needs no more than lower case.
        text = text.lower() if text.isascii() else self.normalize(text)
        if text.isalpha():
            return [text]
        if text[:-1].isalpha() and text[-1] in ".,;:!?":
            return [text[:-1], text[-1]]
        return self.split.findall(text)

    def _plain(self, text: str) -> list[int]:
        words = self._words
        return [i for word in self._split(text) for i in words[word]]

    def _run(self, run: str) -> str:
        """Ids, joined by spaces, of a text without white space or special tokens."""
        return " ".join(map(str, self._plain(run)))

    def id_runs(self, text: str) -> list[str]:
        """Ids of any text in runs, each joined by spaces.

        Nothing that encoding does reaches across white space, so each run is encoded once.
        """
        if any(c in text for c in _SEPARATORS) or any(x in text for x in self.special):
            ids = self.encode(text)
            return [" ".join(map(str, ids))] if ids else []
        runs = self.runs
        return [ids for ids in [runs[r] for r in text.split()] if ids]

    def encode(self, text: str) -> list[int]:
        """Ids of any text; special tokens are found in the raw text."""
        if self.cut is None:
            return self._plain(text)
        out: list[int] = []
        for i, piece in enumerate(self.cut.split(text)):
            out += [self.special[piece]] if i % 2 else self._plain(piece)
        return out


class TextDecoder:
    """Ids to text, one id at a time; holds at most the bytes of one unfinished character.

    ``joined`` gives tokens as they are with a space between, as libraries read ids back whose
    vocabulary has no decoder; what it holds is whether a token came before.
    """

    def __init__(self, codec: Codec, joined: bool = False):
        self._names, self._special, self._end = codec.names, codec.special, codec.end
        self._written = codec.written
        self._joined, self._between = joined, ""
        self._bytes = codec.byte_of
        self._state = None if joined else codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token_id: int) -> str:
        name = self._names[token_id]
        if self._joined:
            between, self._between = self._between, " "
            return between + name
        if name in self._special:
            return self._state.decode(b"", final=True) + name
        end = self._end
        ended = bool(end) and name.endswith(end)
        raw = bytes(self._bytes[c] for c in (name[: -len(end)] if ended else name))
        return self._state.decode(raw, final=ended) + (" " if ended else "")

    def read(self, numbers: str) -> str:
        """The same for many ids, written in decimals with spaces between."""
        if not self._joined:
            return "".join([self.feed(int(i)) for i in numbers.split()])
        if not numbers:
            return ""
        between, self._between = self._between, " "
        written = self._written
        return between + " ".join([written[i] for i in numbers.split(" ")])

    def finish(self) -> str:
        return "" if self._joined else self._state.decode(b"", final=True)


def spoken(codec: Codec, numbers: str) -> str:
    """Text that ids, written in decimals, decode to where the vocabulary has no decoder."""
    decoder = TextDecoder(codec, joined=True)
    return decoder.read(numbers) + decoder.finish()


def _worker_memory() -> types.ModuleType:
    """Holds codecs and encoded words as long as the worker lives; tasks come and go."""
    return sys.modules.setdefault("_shelfcast_bpe_memory", types.ModuleType("_shelfcast_bpe_memory"))


def _codec_of(name: str) -> Codec:
    memory = _worker_memory()
    held = getattr(memory, "held", None)
    if held is None or held[0] != name:
        held = memory.held = (name, _load(name))
    return held[1]


def _load(name: str, **sizes: int) -> Codec:
    with open(SparkFiles.get(name), encoding="utf-8") as file:
        return Codec(json.load(file), **sizes)


def _numbers(runs: list[str]) -> np.ndarray:
    return np.fromstring(" ".join(runs), np.int32, sep=" ") if runs else np.zeros(0, np.int32)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ship(spark: SparkSession, path: str) -> str:
    """Gives the vocabulary file to every worker, also to executors that join later."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, token ids and their number."""
    name = ship(docs.sparkSession, path)

    def run(batch):
        codec = _codec_of(name)
        ids = [_numbers(codec.id_runs(t.as_py() or "")) for t in batch.column(1)]
        yield {"doc_id": batch.column(0), "n_tokens": [len(i) for i in ids], "ids": ids}

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    return map_batches(rows, run, "doc_id long, n_tokens long, ids array<int>")


def encode_documents(
    docs: DataFrame, path: str, keep: tuple[str, ...], text: str = "text", words: int = 100_000, runs: int = 50_000,
) -> DataFrame:
    """Columns ``keep``, token ids, their number and the digest of the text decoded from them.

    What a task remembers goes with the task, so workers that do other work next keep nothing.
    """
    name = ship(docs.sparkSession, path)
    given = docs.select(docs[text].alias("_text"), *keep)
    held: list[Codec] = []

    def run(batch):
        if not held:
            held.append(_load(name, words=words, runs=runs))
        codec = held[0]
        ids, digests_ = [], []
        for value in batch.column(0):
            found = codec.id_runs(value.as_py() or "")
            ids.append(_numbers(found))
            digests_.append(_digest(spoken(codec, " ".join(found))))
        counts = [len(i) for i in ids]
        own = {n: batch.column(i + 1) for i, n in enumerate(keep)}
        yield {**own, "n_tokens": counts, "ids": ids, "decoded_sha256": digests_}

    kinds = dict(given.dtypes)
    schema = ", ".join([*(f"{n} {kinds[n]}" for n in keep), "n_tokens long", "ids array<int>", "decoded_sha256 string"])
    return map_batches(given, run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Per row: key and text of the ids, through the incremental state machine."""
    name = ship(encoded.sparkSession, path)

    def run(batch):
        codec = _codec_of(name)
        for key_, ids in zip(batch.column(0), batch.column(1), strict=True):
            state = TextDecoder(codec)
            out = "".join(map(state.feed, ids.as_py() or [])) + state.finish()
            yield {"doc_id": [key_.as_py()], "text": [out]}

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: number of tokens, digest of the ids and of the text that the ids decode to."""
    name = ship(docs.sparkSession, path)

    def run(batch):
        codec = _codec_of(name)
        counts, ids, decoded = [], [], []
        for value in batch.column(1):
            found = codec.id_runs(value.as_py() or "")
            numbers = " ".join(found)
            counts.append(numbers.count(" ") + 1 if numbers else 0)
            ids.append(_digest(numbers))
            decoded.append(_digest(spoken(codec, numbers)))
        yield {"doc_id": batch.column(0), "n_tokens": counts, "ids_sha256": ids, "decoded_sha256": decoded}

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(rows, run, schema)
