"""Chat formatting: from heterogeneous records to canonical turns, and to one marked text.

A record's layout is recognised by its fingerprint, a hash of the nested field paths that hold a
value. Fingerprints select declarative mappings, so a table may mix layouts row by row, as JSON
lines read with a merged schema do. Everything is DataFrame expressions.

The template writes a turn as ``### role: text</turn>`` and a line feed. ``&``, ``<``, ``#`` (and
``:`` in roles) become character entities, so no text can hold a marker and reading back gives
every text unchanged.

Defined results: a null text or role is empty; fields outside the known vocabulary are ignored
whatever their names; a record whose fingerprint no mapping names keeps its row with layout
``unknown`` and null turns; no turns give the empty text. Rows of one conversation with equal
turn numbers are ordered by role and text, and a null turn number comes first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN_END = "</turn>\n"
_TURNS = "array<struct<role:string,text:string>>"

# What speakers are called in common layouts.
ROLES = {
    "human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant",
}


@dataclass(frozen=True)
class Layout:
    """Field paths that hold a value in such a record, and its turns as an expression."""

    name: str
    paths: tuple[str, ...]
    turns: Callable[[], Column]


def _turn(role: str | Column, text: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else F.coalesce(role, F.lit(""))
    return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _canonical(role: Column) -> Column:
    named = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(F.try_element_at(named, F.coalesce(role, F.lit(""))), role)


def _pair(ask: str, answer: str) -> Callable[[], Column]:
    return lambda: F.array(_turn("user", F.col(ask)), _turn("assistant", F.col(answer)))


def _instructed(answer: str) -> Callable[[], Column]:
    return lambda: F.array(
        _turn("user", F.concat_ws("\n\n", F.col("instruction"), F.col("input"))),
        _turn("assistant", F.col(answer)),
    )


def _list(column: str, role: str, text: str) -> Callable[[], Column]:
    return lambda: F.transform(F.col(column), lambda m: _turn(_canonical(m[role]), m[text]))


def _after_system(rest: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.concat(F.array(_turn("system", F.col("system"))), rest())


_PLAIN = (
    Layout("messages", ("messages[].role", "messages[].content"), _list("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), _list("conversations", "from", "value")),
    Layout("prompt_response", ("prompt", "response"), _pair("prompt", "response")),
    Layout("prompt_completion", ("prompt", "completion"), _pair("prompt", "completion")),
    Layout("question_answer", ("question", "answer"), _pair("question", "answer")),
    Layout("instruction_output", ("instruction", "output"), _pair("instruction", "output")),
    Layout("instruction_input_output", ("instruction", "input", "output"), _instructed("output")),
)
LAYOUTS = _PLAIN + tuple(
    Layout(f"system_{x.name}", ("system", *x.paths), _after_system(x.turns)) for x in _PLAIN
)


def _canonical_paths(paths) -> str:
    return "\n".join(sorted(paths))


def _known_paths() -> list[str]:
    return sorted({p for layout in LAYOUTS for p in layout.paths})


def _has_value(schema: T.StructType, path: str) -> Column | None:
    """Whether a record holds a value at the path; None where the table has no such field."""
    outer, _, inner = path.partition("[].")
    field = next((f for f in schema.fields if f.name == outer), None)
    if field is None:
        return None
    if not inner:
        return None if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(outer).isNotNull()
    kind = field.dataType
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)):
        return None
    if inner not in kind.elementType.fieldNames():
        return None
    return F.coalesce(F.exists(F.col(outer), lambda m: m[inner].isNotNull()), F.lit(False))


def fingerprint(records: DataFrame) -> Column:
    """Hash of the known field paths that hold a value in a record."""
    held = []
    for path in _known_paths():
        has = _has_value(records.schema, path)
        if has is not None:
            held.append(F.when(has, F.lit(path)))
    return F.xxhash64(F.concat_ws("\n", *held) if held else F.lit(""))


def canonical_turns(records: DataFrame) -> DataFrame:
    """Adds ``layout`` and ``turns``, an array of (role, text), to every record."""
    schema = records.schema
    print_ = fingerprint(records)
    layout, turns = F.lit("unknown"), F.lit(None).cast(_TURNS)
    for x in LAYOUTS:
        if all(_has_value(schema, p) is not None for p in x.paths):
            same = F.col("_fingerprint") == F.xxhash64(F.lit(_canonical_paths(x.paths)))
            layout = F.when(same, F.lit(x.name)).otherwise(layout)
            turns = F.when(same, x.turns()).otherwise(turns)
    made = records.withColumn("_fingerprint", print_)
    return made.withColumns({"layout": layout, "turns": turns}).drop("_fingerprint")


def records_from_rows(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One record in the ``messages`` layout per conversation, from a row per turn."""
    message = F.struct(
        rows[turn].alias("turn"),
        F.coalesce(rows[role], F.lit("")).alias("role"),
        F.coalesce(rows[text], F.lit("")).alias("content"),
    )
    return (
        rows.select(rows[key].alias(key), message.alias("message"))
        .groupBy(key)
        .agg(F.sort_array(F.collect_list("message")).alias("messages"))
    )


# ------------------------------------------------------------------------------- the template


def escape(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), ("#", "&#35;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def unescape(text: Column) -> Column:
    for plain, entity in ((":", "&#58;"), ("#", "&#35;"), ("<", "&lt;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def _head(role: Column) -> Column:
    return F.concat(F.lit("### "), F.replace(escape(role), F.lit(":"), F.lit("&#58;")), F.lit(": "))


def render(records: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """Adds ``formatted`` and ``loss_mask`` to records with ``turns``.

    The mask has an entry per turn: of its ``chars`` characters in the output, after ``skip`` the
    next ``loss`` ones are learned (0 for other roles).
    """
    pieces = F.transform(
        F.col("turns"),
        lambda t: F.struct(_head(t["role"]).alias("head"), escape(t["text"]).alias("body"), (t["role"] == learn_from).alias("learn")),
    )
    formatted = F.array_join(
        F.transform(F.col("_pieces"), lambda p: F.concat(p["head"], p["body"], F.lit(TURN_END))), ""
    )
    mask = F.transform(
        F.col("_pieces"),
        lambda p: F.struct(
            (F.length(p["head"]) + F.length(p["body"]) + len(TURN_END)).alias("chars"),
            F.length(p["head"]).alias("skip"),
            F.when(p["learn"], F.length(p["body"])).otherwise(0).alias("loss"),
        ),
    )
    return (
        records.withColumn("_pieces", pieces)
        .withColumns({"formatted": formatted, "loss_mask": mask})
        .drop("_pieces")
    )


def _written_turns(formatted: Column) -> Column:
    """The turns of an output text, without their end marks."""
    parts = F.split(formatted, TURN_END, -1)
    return F.slice(parts, 1, F.size(parts) - 1)


def read_back(formatted: Column) -> Column:
    """Turns of an output text: an array of (role, text)."""

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, ": ", 1)
        role = F.substr(head, F.lit(len("### ") + 1))
        return F.struct(
            unescape(role).alias("role"),
            unescape(F.substr(piece, F.length(head) + F.lit(3))).alias("text"),
        )

    return F.transform(_written_turns(formatted), turn)


def learned_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    cut = F.zip_with(
        _written_turns(formatted),
        mask,
        lambda piece, m: F.substr(piece, m["skip"] + F.lit(1), m["loss"]),
    )
    return F.array_join(F.transform(cut, unescape), "")


def format_conversations(rows: DataFrame) -> DataFrame:
    """Rows by turn to one row per conversation: layout, turns, formatted text and loss mask."""
    return render(canonical_turns(records_from_rows(rows)))
