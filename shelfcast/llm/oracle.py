"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

#: A word: a maximal run of characters outside \x20 and \x09 to \x0D.
_WORD = r"[^\x20\x09-\x0D]+"

QUALITY_MEASURES = rf"""
words as (
  select doc_id, coalesce(text, '') as x, regexp_extract_all(coalesce(text, ''), '{_WORD}') as ws
  from documents
),
grams as (
  select doc_id, i, list_slice(ws, i, i + 7) as g
  from words, unnest(generate_series(1, len(ws) - 7)) u(i)
),
twice as (
  select doc_id, i from grams qualify count(*) over (partition by doc_id, g) > 1
),
repeats as (
  select doc_id, count(distinct i + k) as n from twice, generate_series(0, 7) s(k) group by doc_id
),
lines as (
  select doc_id, line, count(*) as c
  from words, unnest(string_split(x, chr(10))) u(line)
  where regexp_matches(line, '{_WORD}')
  group by doc_id, line
),
dups as (select doc_id, sum(c) as n_lines, sum(c - 1) as n from lines group by doc_id),
echoes as (
  select doc_id, count(*) as n
  from words, unnest(generate_series(2, len(ws))) u(i)
  where ws[i] = ws[i - 1]
  group by doc_id
),
measures as (
  select doc_id, len(ws)::bigint as n_words,
    length(array_to_string(ws, ''))::bigint as word_chars,
    length(regexp_replace(x, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    coalesce(dups.n, 0)::bigint as n_dup_lines,
    coalesce(repeats.n, 0)::bigint as n_repeat_words,
    coalesce(dups.n_lines, 0)::bigint as n_lines,
    length(regexp_replace(x, '[^A-Z]', '', 'g'))::bigint as n_upper,
    coalesce(echoes.n, 0)::bigint as n_echo_words
  from words left join repeats using (doc_id) left join dups using (doc_id)
    left join echoes using (doc_id)
),
judged as (
  select *, (n_words < 20)::bigint
    + 2 * (100 * n_repeat_words > 30 * n_words)::bigint
    + 4 * (100 * n_dup_lines > 50 * n_lines)::bigint
    + 8 * (100 * n_symbols > 10 * n_words)::bigint
    + 16 * (word_chars < 2 * n_words)::bigint
    + 32 * (word_chars > 25 * n_words)::bigint
    + 64 * (100 * n_echo_words > 30 * n_words)::bigint
    + 128 * (100 * n_upper > 60 * word_chars)::bigint as failed_rules
  from measures
)"""

def _crc32(codes: str) -> str:
    """Unsigned crc32 of a list of byte values."""
    bit = "xor(c >> 1, 3988292384 * (c & 1))"
    return (
        f"xor(list_reduce({codes}, lambda acc, b: list_reduce(range(8), lambda c, i: {bit}, "
        "xor(acc, b::bigint)), 4294967295::bigint), 4294967295::bigint)"
    )


def _bytes(text: str) -> str:
    """Byte values of a string in UTF-8."""
    return (
        f"list_transform(range(strlen({text})), "
        f"lambda k: ('0x' || substr(hex({text}), (2 * k + 1)::bigint, 2))::bigint)"
    )


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::varchar)::varchar || ':' || {name}::varchar, '-')"


def _tree(leaves: str, levels: int, prefix: str) -> str:
    """Levels of 16-fold runs over (grp, slot, n, digest), then kids per run, then each group's root."""
    parts, below = [], leaves
    for k in range(levels):
        runs, nodes = f"{prefix}runs{k}", f"{prefix}{k + 1}"
        parts.append(
            f"{runs} as (select grp, n, slot // 16 as node, list(digest order by slot) as kids "
            f"from {below} group by grp, n, slot // 16)"
        )
        parts.append(
            f"{nodes} as (select grp, node as slot, (n + 15) // 16 as n, "
            f"case when n = 1 then kids[1] else sha256(array_to_string(kids, '')) end as digest from {runs})"
        )
        below = nodes
    return ",\n".join(parts)


def _climb(state: str, levels: int, prefix: str, kept: str) -> str:
    """Follows (grp, slot, n, cur, proof) up the runs; the last step is ``prefix`` + 'end'."""
    parts, now = [], state
    for k in range(levels):
        later = f"{prefix}end" if k == levels - 1 else f"{prefix}climb{k + 1}"
        left = "array_to_string(kids[1:s.slot % 16], '')"
        right = "array_to_string(kids[s.slot % 16 + 2:], '')"
        parts.append(
            f"{later} as (select {kept}, s.grp, s.slot // 16 as slot, (s.n + 15) // 16 as n, "
            f"case when s.n = 1 then cur else sha256({left} || cur || {right}) end as cur, "
            f"case when s.n = 1 then proof else proof || {left} || {right} end as proof "
            f"from {now} s join {prefix}runs{k} r on s.grp = r.grp and s.slot // 16 = r.node)"
        )
        now = later
    return ",\n".join(parts)


#: Levels that the SQL spells out: groups of 16^5 rows, 16^4 groups.
_DEPTH, _TOP_DEPTH = 5, 4

MERKLE = f"""
with given as (
  select doc_id, source, lang, n_chars, text,
    case when {_crc32(_bytes("doc_id::varchar"))} % 5 = 0
      then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end as other
  from documents
),
hashed as (
  select doc_id, coalesce('s' || source, 'n') as grp,
    sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text")))}) as digest,
    sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "other")))}) as changed
  from given
),
leaves as (
  select *, row_number() over (partition by grp order by doc_id nulls first, digest) - 1 as slot,
    count(*) over (partition by grp) as n
  from hashed
),
{_tree("leaves", _DEPTH, "t")},
subroots as (
  select '' as grp, grp as own, digest, row_number() over (order by grp) - 1 as slot, count(*) over () as n
  from t{_DEPTH}
),
{_tree("subroots", _TOP_DEPTH, "u")},
start as (select doc_id, digest, grp, slot, n, changed as cur, '' as proof from leaves),
{_climb("start", _DEPTH, "t", "doc_id, digest")},
across as (
  select e.doc_id, e.digest as leaf, u.digest as subroot, u.grp, u.slot, u.n, e.cur, e.proof
  from tend e join subroots u on e.grp = u.own
),
{_climb("across", _TOP_DEPTH, "u", "doc_id, leaf, subroot")}
select doc_id, leaf, subroot, r.digest as root, sha256(proof) as proof_sha256, cur as folded_root,
  cur = r.digest as verified
from uend cross join u{_TOP_DEPTH} r"""

SPELLING = rf"""
with runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
  from documents, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) u(run)
  group by all
),
named as (
  select run, n, {_crc32(_bytes("(coalesce(doc_id::varchar, '') || ':' || run)"))} as h
  from runs where length(run) >= 5
),
results as (
  select case when h % 97 = 0
    then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n
  from named
),
vocabulary as (
  select word, sum(n)::bigint as n from results where length(word) >= 5 group by word having sum(n) >= 3
),
less as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from vocabulary, unnest(generate_series(1, length(word))) u(i)
),
pairs as (
  select a.word, b.word as near, b.n as near_n from less a join less b using (i, rest) where a.word <> b.word
  union
  select a.word, b.word, b.n from less a join vocabulary b on a.rest = b.word
  union
  select b.word, a.word, a.n from less a join vocabulary b on a.rest = b.word
),
best as (
  select word, count(*) as n_near, min((-near_n, near)) as top from pairs group by word
),
forms as (
  select v.word, v.n, coalesce(n_near, 0)::bigint as n_near,
    case when -top[1] >= 2 * n then top[2] end as form, case when -top[1] >= 2 * n then -top[1] end as form_n
  from vocabulary v left join best using (word)
),
chains as (
  with recursive steps as (
    select word, word as here, form as onward from forms
    union all
    select s.word, f.word, f.form from steps s join forms f on s.onward = f.word
  )
  select word, here as root from steps where onward is null
)
select word, form, root, n, n_near, form_n from forms join chains using (word)"""

#: A word of the decontamination, after A-Z are lower-cased.
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _plain_words(text: str) -> str:
    folded = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({folded}, '{_PLAIN}')"


DECONTAMINATION = f"""
with doc_words as (
  select row_number() over () as row, doc_id, {_plain_words("text")} as ws from documents
),
item_words as (select coalesce(item_id::varchar, '') as item, {_plain_words("text")} as ws from benchmark),
item_windows as (
  select distinct item, list_slice(ws, i, i + 9) as win
  from item_words, unnest(generate_series(1, greatest(len(ws) - 9, 1))) u(i) where len(ws) > 0
),
lengths as (select distinct len(win) as size from item_windows),
doc_windows as (
  select row, i, size, list_slice(ws, i, i + size - 1) as win
  from doc_words, lengths, unnest(generate_series(1, len(ws) - size + 1)) u(i)
),
hits as (select row, i, size, win from doc_windows where win in (select win from item_windows)),
covered as (
  select row, count(distinct i + k) as n_hit from hits, unnest(generate_series(0, size - 1)) u(k) group by row
),
held as (
  select row, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items
  from (select distinct row, win from hits) join item_windows using (win) group by row
)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join covered using (row) left join held using (row)"""

ORACLE: dict[str, str] = {
    "op2_chat_formatting": r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all
  select -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
marked as (
  select *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '#', '&#35;') as body,
    replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '#', '&#35;'), ':', '&#58;') as head
  from rows
),
joined as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as spoken,
    coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '') as learned,
    sum(length('### ' || head || ': ' || body || '</turn>' || chr(10)))::bigint as formatted_chars
  from marked group by conv_id
)
select conv_id, n_turns, sha256(spoken) as turns_sha256, length(learned) as loss_chars,
  sha256(learned) as loss_sha256, formatted_chars
from joined""",
    "op8_quality_rules": f"""
with {QUALITY_MEASURES}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed_rules & 3 > 0 as base_failed, failed_rules = 0 as kept, failed_rules
from judged""",
    "op11_merkle_manifest": MERKLE,
    "op12_spelling_variants": SPELLING,
    "op13_benchmark_decontamination": DECONTAMINATION,
}
