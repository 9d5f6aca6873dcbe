"""The text operators on small tables, against brute force, round trips and defined edge cases."""

import collections
import hashlib
import json
import os
import random
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfcast.llm import (
    blocks,
    bpe,
    chat_format,
    compare,
    compression_classifier,
    fingerprints,
    fm_dedup,
    jaccard_join,
    mixing,
    pii,
    quality_rules,
    suffix_dedup,
)
from shelfcast.llm.components import components
from shelfcast.llm.oracle import ORACLE
from shelfcast.llm.queries import QUERIES
from shelfcast.llm.tables import table

FOLDER = "/root/testdata/sf0.001"
WORDS = "[^\\x20\\x09-\\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, FOLDER, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, very long, repeated and tied rows, with columns of clashing names."""
    rng = random.Random(3)
    long = " ".join(rng.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(30_000))
    passage = " ".join(f"passage{i}" for i in range(80))
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4),
        (4, "one", "en", "b", 3), (5, "one", "en", "b", 3), (5, "one", "en", "b", 3),
        (6, long, "en", "c", len(long)), (7, "x" * 50_000, "en", "c", 50_000),
        (8, f"start {passage} end é", "fr", "a", 0), (9, f"other {passage} tail ñ", "es", "a", 0),
        (None, f"lost {passage}", "en", "a", 0), (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS).withColumns({"ids": F.lit(1), "n": F.lit("x"), "sig": F.lit(0)})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def split(text):
    return re.findall(WORDS, text)


# ------------------------------------------------------------------------------------ queries


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert compare.difference(QUERIES[name](spark, FOLDER), compare.connect(FOLDER), ORACLE[name]) is None


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


# ------------------------------------------------------------------------------- Jaccard join


def shingles(text):
    words = split(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    x, y = top(a), top(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_join_equals_brute_force(docs, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(docs).collect()}
    assert got == brute_components(texts)


def test_join_of_a_large_group_near_the_threshold(spark):
    """Copies of one text, each with its own changes: some pairs link, many do not."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    made = {}
    for i in range(120):
        words = list(base)
        for k in range(rng.randint(0, 5)):
            words[rng.randrange(120)] = f"own{i}x{k}"
        made[i] = " ".join(words)
    frame = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(frame).collect()}
    assert got == brute_components(made)


def test_join_of_odd_rows(odd, nothing):
    rows = jaccard_join.join(odd).collect()
    assert len(rows) == 12
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None}
    assert found[1] == (0, 1) and found[2] == (0, 2) and found[3] == (0, 3)
    assert found[4] == (1, 4) and found[5] == (1, 4)
    # 78 shared of 80 + 80 - 78 and of 80 + 77 - 76.
    assert found[8][1] == found[9][1] == 8
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 2, 3, 4, 6, 7, 8]
    assert jaccard_join.join(nothing).count() == 0


def test_near_copies_without_ids_link(spark):
    """Null ids hold sets, bridge others and stay once; ids that repeat keep their texts apart."""
    base = [f"w{i}" for i in range(60)]
    near = lambda *at: " ".join(f"x{i}" if i in at else w for i, w in enumerate(base))
    rows = [
        (1, near()), (None, near(3)), (3, near(3, 5)), (None, near(3)), (None, "alone " * 3),
        (7, near(50)), (7, " ".join(f"other{i}" for i in range(40))),
        (None, " ".join(f"lost{i}" for i in range(40))), (None, " ".join(f"lost{i}" for i in range(39))),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.join(frame).collect()]
    assert sorted(found, key=str) == sorted([
        (1, 56, 1), (None, 56, 1), (3, 56, 1), (None, 56, 1), (None, 1, None), (7, 56, 1), (7, 36, 7),
        (None, 36, None), (None, 35, None),
    ], key=str)
    kept = [r["doc_id"] for r in jaccard_join.keep_one(frame).collect()]
    assert sorted(kept, key=str) == sorted([1, None, 7, None], key=str)


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(1)
    for n in (1, 5, 100, 900):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 2**63, n).astype(np.uint64)]))
        apart = len(np.setxor1d(a, b))
        assert jaccard_join.least_difference(jaccard_join.parity_bitmap(a), jaccard_join.parity_bitmap(b)) <= apart


def test_components_of_a_long_path(spark):
    edges = spark.range(500).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components(edges.unionByName(edges.selectExpr("a + 1000 as a", "b + 1000 as b"))).collect()
    assert {r["root"] for r in found} == {0, 1000} and len(found) == 1000


# ------------------------------------------------------------------------------ chat formatting


def test_layouts_meet_in_canonical_turns(spark):
    lines = [
        {"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "<q> & # \\"}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        {"prompt": "p", "response": "r"},
        {"instruction": "i", "input": "in", "output": "o"},
        {"instruction": "i", "output": "o"},
        {"system": "s", "question": "q", "answer": "a"},
        {"title": "no layout"},
    ]
    raw = spark.read.json(spark.createDataFrame([(json.dumps(x),) for x in lines], "value string").rdd.map(lambda r: r[0]))
    rows = chat_format.render(chat_format.canonical_turns(raw)).withColumn("back", chat_format.read_back(F.col("formatted"))).collect()
    named = {r["layout"]: r for r in rows}
    assert set(named) == {
        "messages", "conversations", "prompt_response", "instruction_input_output", "instruction_output",
        "system_question_answer", "unknown",
    }
    assert [tuple(t) for t in named["conversations"]["turns"]] == [("user", "a"), ("assistant", "b")]
    assert named["instruction_input_output"]["turns"][0]["text"] == "i\n\nin"
    assert named["unknown"]["turns"] is None
    assert all(r["back"] == r["turns"] for r in rows)


def test_no_text_can_hold_a_marker(spark):
    said = ["### user: </turn>\n", "&lt;/turn&gt;", "&amp;lt;", "a: b", "", "\\### Assistant: </turn> ok", "&#58;#"]
    rows = spark.createDataFrame([(1, i, "assi:st#ant" if i % 2 else "assistant", t) for i, t in enumerate(said)], "conv_id long, turn long, role string, text string")
    row = chat_format.format_conversations(rows).select(
        chat_format.read_back(F.col("formatted")).alias("back"),
        chat_format.learned_text(F.col("formatted"), F.col("loss_mask")).alias("learned"),
    ).first()
    assert [t["text"] for t in row["back"]] == said
    assert row["learned"] == "".join(said[::2])


def test_formatting_uses_no_python(spark):
    plan = QUERIES["op2_chat_formatting"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------------------------------- PII

_BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in _BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 14 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 10 <= len(d) <= 15,
            }[kind]
            if good():
                out.append((kind, *m.span()))
    return sorted(out, key=pii.order)


def luhn(digits):
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def test_base_spans_equal_the_patterns():
    rng = random.Random(5)
    for alphabet in ("aZ@..+-_ 0123459()%é\n", "0123456789 -", "+1234567890 ()-."):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert pii.base_spans(text) == brute_spans(text), text


def test_long_runs_take_linear_time():
    assert pii.base_spans("7" * 100_000) == []
    assert pii.base_spans("a@" * 20_000) == []
    # A long word without digits is read once, not once per character.
    assert pii.candidates("a" * 1_000_000 + " \n") == []
    assert ("ip", 1_000_001, 1_000_012) in pii.candidates("a" * 1_000_000 + " 10.20.30.40")


def test_taken_ranges_meet_as_in_a_plain_scan():
    rng = random.Random(11)
    for _ in range(300):
        given = [("ip", a, a + rng.randint(1, 9)) for a in (rng.randint(0, 60) for _ in range(rng.randint(0, 8)))]
        taken, kept = pii._Taken(given), [(a, b) for _, a, b in given]
        for _ in range(20):
            a = rng.randint(0, 60)
            b = a + rng.randint(1, 6)
            met = any(a < y and b > x for x, y in kept)
            assert taken.meets(a, b) == met
            if not met:
                taken.add(a, b)
                kept.append((a, b))


def test_redaction_covers_base_and_secrets(spark, odd, nothing):
    rows = [(i, f"word more a{i}.b@mail{i}.example.com then password={i:018x} plain words follow here") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("c0", F.lit("kept"))
    model = pii.fit(frame)
    for r in pii.redact(frame, model).collect():
        assert "[EMAIL]" in r["text"] and f"{r['doc_id']:018x}" not in r["text"]
        assert r["text"].startswith("word more ") and r["text"].endswith("plain words follow here") and r["c0"] == "kept"
    assert pii.detect(odd, pii.fit(odd)).where("size(spans) > 0").count() == 0
    assert pii.redact(nothing, pii.fit(nothing)).count() == 0


def test_long_secrets_go_whole(spark):
    rng = random.Random(13)
    word = lambda n: "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGH0123456789") for _ in range(n))
    plain = [(i, f"more words see page{i} of book{i} and password={word(18)} plain words follow here") for i in range(60)]
    model = pii.fit(spark.createDataFrame(plain, "doc_id long, text string"))
    secret = word(400)
    for given in (secret, f'"{secret}"', f"'{secret}'"):
        text = f"first words token={given} last words"
        start = text.index("token")
        span = ("secret", start, start + len(f"token={given}"))
        assert span in pii.candidates(text) and pii.evidence(text, span, set()) == 1
        assert pii.masked(text, pii.find(text, model)[1]) == "first words [SECRET] last words"
    # Words of any length are proposed whole, and so are assignments inside a long address.
    link = f"https://host.example/{word(300)}?token={secret}"
    text = f"first words {link} last words"
    found = pii.candidates(text)
    assert ("secret", 12, 12 + len(link)) in found and ("secret", text.index("token"), 12 + len(link)) in found
    assert ("secret", 0, 90) in pii.candidates("A1" * 45 + " last words")
    named = f'{"n" * 60}.password="{word(9)} {word(9)}"'
    assert ("secret", 6, 6 + len(named)) in pii.candidates(f"first {named} last")
    assert ("card", 0, 60) in pii.candidates("4" * 60)
    for many in ("a1=", 'a1="', "token=", "token: '", "a.", "x=token=", "a--", "1-", "(1", "12 ", "--"):
        pii.candidates(many * 60_000)


def test_trees_find_what_no_rule_of_theirs_names(spark):
    rng = random.Random(17)
    hexed = lambda n=40: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    words = lambda: " ".join(rng.choice(("page12", "chapter", "order66", "river", "2024", "of", "the")) for _ in range(8))
    phone = lambda: f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    rows = [(i, f"{words()} token = \"{hexed()}\" {words()} +1 {phone()} {words()} password: {hexed(38)} {words()}") for i in range(300)]
    model = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))

    def spans(value):
        text = f"{words()} {value} {words()}"
        at = text.index(value)
        # The rules alone, which say what fitting starts from.
        base = set(pii.base_spans(text))
        ruled = any(pii.evidence(text, s, base) for s in pii.candidates(text) if s[1] <= at and s[2] >= at + len(value))
        return ruled, any(s <= at and e >= at + len(value) for _, s, e in pii.find(text, model)[1])

    # Secrets that nothing names, phone numbers without a country, and names that no list holds.
    for made in (hexed, phone, lambda: f"sesskey={hexed()}"):
        ruled, found = zip(*[spans(made()) for _ in range(100)], strict=True)
        assert not any(ruled) and sum(found) >= 90
    plain = [f"{words()} {w} {words()}" for w in ("order12345", "1234567890123456", "300.12.13.14", "internationalization", "me@host")]
    assert [pii.find(t, model)[1] for t in plain] == [[]] * len(plain)


def test_planted_personal_data_is_found_in_real_text(spark):
    rng = random.Random(19)
    sf_documents = table(spark, "/root/testdata/sf0.1", "documents")
    model = pii.fit(sf_documents)
    kinds = {
        "email": lambda: f"ann.b{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.org",
        "ip": lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)),
        "phone": lambda: f"+44 {rng.randint(100, 999)} 555 {rng.randint(1000, 9999)}",
        "secret": lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40)),
    }
    texts = [r["text"] for r in sf_documents.where("length(text) > 200").orderBy("doc_id").limit(100).collect()]
    for kind, make in kinds.items():
        found = 0
        for text in texts:
            value, cut = make(), text.find(" ", 100)
            if cut < 0:
                cut = len(text)
            planted = f"{text[:cut]} {value} {text[cut:]}"
            found += any(k == kind and s <= cut + 1 and e >= cut + 1 + len(value) for k, s, e in pii.find(planted, model)[1])
        assert found >= 0.9 * len(texts), (kind, found)


def test_examples_do_not_show_their_evidence(spark):
    text = 'words then password="a1b2c3d4e5" and words'
    span = ("secret", 11, 32)
    bare = ("secret", 21, 31)
    assert text[11:32] == 'password="a1b2c3d4e5"' and text[21:31] == "a1b2c3d4e5"
    # The format of a value does not depend on its name, nor the context on the value.
    assert pii.format_features("secret", text[11:32]) == pii.format_features("secret", text[slice(*bare[1:])])
    other = text.replace("a1b2c3d4e5", "tomorrows!")
    assert pii.context_features(text, span) == pii.context_features(other, span)
    # A part of a labelled value is no counterexample.
    told = [(f, e) for f, _, e in pii.examples(text)]
    assert sum(e == 1 for _, e in told) == 1
    assert all(e for f, e in told if f == pii.format_features(*("secret", "a1b2c3d4e5")))


def test_equal_candidates_count_once_in_the_draw(spark):
    rows = [(i, "the same 1234567 words and number again") for i in range(3000)]
    rows += [(9000 + i, f"word {i} password={i * 7919 + 10**11:x}q{i} follows") for i in range(40)]
    model = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"), sample=200)
    assert model.form is not None and "secret" in model.thresholds
    assert pii.find("words and password=1a2b3c4d5e6fq7 follow", model)[1] == [("secret", 10, 33)]


# ------------------------------------------------------------------------------------- mixing


def brute_targets(sizes):
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    budget, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in capped]
        left = budget - sum(capped.values())
        shares = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        above = [s for s in free if shares[s] > 2 * sizes[s]]
        if not above:
            return {**capped, **shares}
        capped.update({s: 2.0 * sizes[s] for s in above})


def test_mix_meets_its_targets(docs):
    rows = mixing.mix_documents(docs).collect()
    size = collections.Counter()
    taken = collections.Counter()
    for r in rows:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    wanted = brute_targets(size)
    for r in rows:
        assert r["target"] == pytest.approx(wanted[r["source"]]) and r["source_size"] == size[r["source"]]
    for source in size:
        assert abs(taken[source] - wanted[source]) <= 0.05 * size[source] + 200
    again = mixing.mix_documents(docs.repartition(5)).collect()
    assert {(r["doc_id"], r["taken"]) for r in rows} == {(r["doc_id"], r["taken"]) for r in again}


def test_flight_keeps_totals():
    rng = np.random.default_rng(4)
    sizes, shares = rng.integers(1, 900, 3000).astype(float), np.full(3000, 0.37)
    moved = mixing.fly(sizes, shares, rng)
    assert ((moved > 0) & (moved < 1)).sum() <= 2
    assert (moved * sizes).sum() == pytest.approx((shares * sizes).sum())
    assert moved.sum() == pytest.approx(shares.sum())


def test_mix_of_odd_rows(odd, nothing):
    rows = mixing.mix_documents(odd).collect()
    assert len(rows) == 12 and {r["taken"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert mixing.mix_documents(nothing).count() == 0


def test_mix_splits_a_hot_id_over_blocks(spark):
    """20,000 null ids and 10,000 of one id fill no block, and reruns over other partitions agree."""
    ids = F.when(F.col("id") < 20000, None).when(F.col("id") < 30000, 7).otherwise(F.col("id"))
    texts = F.array_join(F.array_repeat(F.lit("w"), (F.col("id") % 3 + 1).cast("int")), " ")
    docs = spark.range(40000).select(ids.alias("doc_id"), texts.alias("text"), F.lit("s").alias("source"))
    sizes = mixing.sized(docs)
    assert sizes.count() == 40000 and sizes.distinct().count() == 40000
    block = F.pmod(F.xxhash64("doc_id", "size", "number", F.lit(1), F.lit(0)), F.lit(10))
    widths = [r["count"] for r in sizes.groupBy(block).count().collect()]
    assert len(widths) == 10 and max(widths) < 4400
    # A text of its own source leaves room for a fractional target.
    goals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"), (F.sum("size") * 0.613).alias("target"))

    def taken(frame):
        rows = mixing.mix(mixing.sized(frame), goals, block=2000).collect()
        return collections.Counter((r["doc_id"], r["size"], r["taken"]) for r in rows)

    first = taken(docs)
    assert sum(first.values()) == 40000 and first == taken(docs.repartition(13))
    total = sum(t * n for (_, _, t), n in first.items())
    assert abs(total - goals.first()["target"]) <= 2


def test_mix_in_blocks_equals_its_total(spark):
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), (F.col("id") % 50 + 1).alias("size"))
    goals = frame.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"), (F.sum("size") * 0.613).alias("target"))
    total = mixing.mix(frame, goals, block=100).agg(F.sum("taken"), F.first("target")).first()
    assert abs(total[0] - total[1]) <= 2


# ------------------------------------------------------------------------------- fingerprints


def test_fingerprints_estimate_and_merge():
    words = [f"w{i}" for i in range(4000)]
    a, b = " ".join(words[:3000]), " ".join(words[1000:])
    x, y, both = fingerprints.sketches(pa.array([a, b, " ".join(words)]))
    assert fingerprints.resemblance(x, y) == pytest.approx(0.5, abs=0.15)
    assert fingerprints.containment(x, both) == pytest.approx(1.0, abs=0.15)
    assert fingerprints.distinct_shingles(both) == pytest.approx(3996, rel=0.3)
    assert (fingerprints.merge(x, y) == both).mean() > 0.95
    assert fingerprints.resemblance(*fingerprints.sketches(pa.array(["", None]))) == 1.0


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_next_documents_in_descending_order(docs, texts, parts):
    ids = sorted(texts, reverse=True)
    after = {a: ids[(i + 1) % len(ids)] for i, a in enumerate(ids)}
    rows = fingerprints.edit_likeness(docs, parts).collect()
    assert len(rows) == len(ids)
    for r in rows:
        changed = fingerprints.edited(texts[r["doc_id"]], texts[after[r["doc_id"]]])
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        true = len(shingles(texts[r["doc_id"]]) & shingles(changed)) / max(1, len(shingles(texts[r["doc_id"]]) | shingles(changed)))
        assert abs(r["near_edited"] - true) < 0.25


def test_fingerprints_of_odd_rows(odd, nothing, spark):
    assert fingerprints.edit_likeness(odd, 4).count() == 12
    assert fingerprints.edit_likeness(nothing, 4).count() == 0
    merged = fingerprints.merged(fingerprints.fingerprint(odd).withColumn("g", F.lit(1)), "g").collect()
    assert len(merged) == 1


# ---------------------------------------------------------------------------------------- BPE


@pytest.fixture(scope="module")
def codec():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return bpe.Codec(json.load(file))


def test_encoding_equals_the_library(codec, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(1)
    made = ["".join(rng.choice("abcdeéßñ 's.,!?0129\n\t日ǘΣσ \x1f½²") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    fixed = ["", "x<|endoftext|>y <|startoftext|>", "ab" * 4000, "thonblewhor" * 900, "é" * 4000, "İ ΟΔΟΣ don't", "a\x1cb"]
    for text in [*texts.values(), *made, *fixed]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        runs = codec.id_runs(text)
        assert [int(i) for run in runs for i in run.split()] == ids
        assert bpe.spoken(codec, " ".join(runs)) == library.decode(ids, skip_special_tokens=False)
        decoder = bpe.TextDecoder(codec, joined=True)
        assert "".join(map(decoder.feed, ids)) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


def test_stream_gives_tokens_before_the_end(codec):
    read = []

    def symbols():
        for c in "thonblewhor" * 200:
            read.append(c)
            yield c

    first = next(codec.stream(symbols()))
    assert first and len(read) <= 6 * codec.lookahead


def test_every_word_goes_through_the_transducer(texts, monkeypatch):
    """All words of the given documents are streamed, and no id is read back but by the decoder."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        own = bpe.Codec(json.load(file))
    streamed, stream = [], own.stream
    monkeypatch.setattr(own, "stream", lambda symbols: streamed.append("".join(symbols)) or stream(symbols))
    runs = [own.id_runs(t) for t in texts.values()]
    words = {w for t in texts.values() for r in t.split() for w in own._split(r)}
    assert len(streamed) >= len(words) > 1000
    fed, read = [], bpe.TextDecoder.read
    monkeypatch.setattr(bpe.TextDecoder, "read", lambda self, ids: fed.append(ids) or read(self, ids) + "?")
    faulty = [bpe.spoken(own, " ".join(r)) for r in runs]
    assert fed == [" ".join(r) for r in runs] and all(f.endswith("?") for f in faulty)


def test_decoding_is_incremental(codec):
    decoder = bpe.TextDecoder(codec)
    out = "".join(decoder.feed(i) for i in codec.encode("日本 é <|endoftext|> x")) + decoder.finish()
    assert out.split() == ["日本", "é", "<|endoftext|>x"]


def test_encoding_of_odd_rows(odd, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = {r["doc_id"]: r["n_tokens"] for r in bpe.encode(odd, path).collect()}
    assert rows[1] == rows[2] == rows[3] == 0 and rows[4] == 1
    assert bpe.digests(nothing, path).count() == 0
    text = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(odd, path), path).collect()}
    assert text[4].strip() == "one"


# -------------------------------------------------------------------------------- deduplication


def brute_bytes(texts, width):
    raw = {i: t.encode() for i, t in texts.items()}
    seen = collections.Counter(t[a : a + width] for t in raw.values() for a in range(len(t) - width + 1))
    out = {}
    for i, t in raw.items():
        gone = bytearray(len(t))
        for a in range(len(t) - width + 1):
            if seen[t[a : a + width]] > 1:
                gone[a : a + width] = b"\1" * width
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out[i] = (len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def brute_words(texts, width):
    seen, out = set(), {}
    for i in sorted(texts):
        words = split(texts[i])
        gone = [False] * len(words)
        for a in range(len(words) - width + 1):
            window = tuple(words[a : a + width])
            if window in seen:
                gone[a : a + width] = [True] * width
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def tangled(spark):
    """Pieces of few texts in many surroundings, with periods and copies."""
    rng = random.Random(11)
    parts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(rng.randint(20, 120))) for _ in range(9)]
    parts.append("lo la " * 90)
    made = {i: rng.choice(["", "é"]).join(rng.choice(parts)[rng.randint(0, 40) :] for _ in range(rng.randint(1, 4))) for i in range(120)}
    return made, spark.createDataFrame(list(made.items()), "doc_id long, text string")


def test_suffixes_equal_brute_force(tangled):
    made, frame = tangled
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.report(frame).collect()}
    assert got == brute_bytes(made, 200)


def test_index_equals_brute_force(tangled):
    made, frame = tangled
    got = {r[0]: tuple(r)[1:] for r in fm_dedup.report(frame).collect()}
    assert got == brute_words(made, 20)


def test_deduplication_of_the_given_documents(docs, texts):
    assert {r[0]: tuple(r)[1:] for r in suffix_dedup.report(docs).collect()} == brute_bytes(texts, 200)
    assert {r[0]: tuple(r)[1:] for r in fm_dedup.report(docs).collect()} == brute_words(texts, 20)


@pytest.mark.parametrize(("module", "brute", "width"), [(suffix_dedup, brute_bytes, 200), (fm_dedup, brute_words, 20)])
def test_a_passage_of_very_many_documents_is_not_one_shard(spark, tangled, monkeypatch, module, brute, width):
    rng = random.Random(17)
    some = lambda n: " ".join(f"{rng.randrange(10**6):x}" for _ in range(n))
    passage, ends = some(60), [some(30) for _ in range(4)]
    made = {i: f"{some(30)} {passage} {rng.choice(ends)} {some(9)}" for i in range(150)}
    frame = spark.createDataFrame(list(made.items()), "doc_id long, text string").repartition(5)
    sent, pieces = [], module.anchors.pieces

    def spy(rows, scheme, multiple, pack, *rest):
        if pack is module._pack:
            sent.append(multiple.groupBy("gram").count().agg(F.max("count")).first()[0] or 0)
        return pieces(rows, scheme, multiple, pack, *rest)

    monkeypatch.setattr(module.anchors, "pieces", spy)
    monkeypatch.setattr(module, "SHARD", 40)
    assert {r[0]: tuple(r)[1:] for r in module.report(frame).collect()} == brute(made, width)
    assert max(sent) <= 40
    # Here nearly all grams are above the size.
    monkeypatch.setattr(module, "SHARD", 2)
    made, frame = tangled
    assert {r[0]: tuple(r)[1:] for r in module.report(frame).collect()} == brute(made, width)


def test_deduplication_of_odd_rows(odd, nothing):
    rows = suffix_dedup.report(odd).collect()
    assert len(rows) == 12 and {r["n_removed"] for r in rows if r["doc_id"] in (1, 2, 3, 4, 5)} == {0}
    assert {r["n_removed"] for r in rows if r["doc_id"] == 7} == {50_000}
    words = fm_dedup.report(odd).collect()
    # The null id comes first, so its passage stays and the later two go.
    assert {r["doc_id"]: r["n_removed"] for r in words if r["doc_id"] in (8, 9)} == {8: 80, 9: 80}
    assert suffix_dedup.report(nothing).count() == fm_dedup.report(nothing).count() == 0


def test_deduplication_with_null_and_repeated_ids(spark):
    """Different texts under one id lose a shared passage whole, at its own borders."""
    passage = " ".join(f"shared{i}" for i in range(60))
    own = lambda name: " ".join(f"{name}{i}" for i in range(30))
    texts = [f"{own('a')} {passage} {own('b')}", f"{own('c')} {passage}", f"{passage} {own('d')}", own("e")]
    for ids in ([None, None, None, None], [7, 7, 7, 8], [1, None, 1, None]):
        rows = list(zip(ids, texts, strict=True))
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))
        expected = brute_words(dict(enumerate(t for _, t in order)), fm_dedup.WIDTH)
        got = [tuple(r) for r in fm_dedup.report(frame).collect()]
        assert sorted(got, key=str) == sorted(((order[i][0], *expected[i]) for i in expected), key=str)
        expected = brute_bytes(dict(enumerate(t for _, t in order)), 200)
        got = [tuple(r) for r in suffix_dedup.report(frame).collect()]
        assert sorted(got, key=str) == sorted(((order[i][0], *expected[i]) for i in expected), key=str)


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(2)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 40))) for _ in range(7)]

    def coded(run):
        before = b""
        for text in run:
            n = suffix_dedup.common(before, text, 0)
            yield n, text[n:]
            before = text

    out = list(suffix_dedup.LoserTree([coded(r) for r in runs]))
    merged = [text for _, text, _ in out]
    assert merged == sorted(t for r in runs for t in r)
    assert [s for *_, s in out][1:] == [len(os.path.commonprefix([a, b])) for a, b in zip(merged, merged[1:], strict=False)]


def test_wavelet_matrix_counts():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 37, 500)
    matrix = fm_dedup.WaveletMatrix(values, 37)
    symbols, at = rng.integers(0, 37, 300), rng.integers(0, 501, 300)
    assert matrix.rank(symbols, at).tolist() == [int((values[:a] == s).sum()) for s, a in zip(symbols, at, strict=True)]


# -------------------------------------------------------------------------------- quality rules


def test_rules_policies_and_ablations(spark, odd, nothing):
    book = quality_rules.ledger(odd)
    rows = {r["doc_id"]: r for r in book.collect()}
    assert rows[1]["n_words"] == rows[3]["n_words"] == 0 and rows[7]["word_chars"] == 50_000
    applied = quality_rules.apply_policies(book, [quality_rules.BASE, quality_rules.STRICT]).collect()
    assert all(r["base_v1"] or not r["strict_v1"] for r in applied)
    found = {r["rule"]: r for r in quality_rules.ablations(book, quality_rules.BASE).collect()}
    few = [r["failed_rules"] & 3 for r in book.collect()]
    assert found["too_few_words"]["n_failed"] == sum(bool(b & 1) for b in few)
    assert found["too_few_words"]["n_only"] == sum(b == 1 for b in few)
    assert quality_rules.ledger(nothing).count() == 0
    kept = quality_rules.keep_passing(odd, quality_rules.STRICT)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 6, 8, 9]


# -------------------------------------------------------------------------------- the classifier


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rows = QUERIES["op9_quality_classifier"](spark, folder).where("held_out").join(labels, "doc_id").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    above = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert right > 0.85 and above > 0.95
    # One id with very many texts gives one of them, and no class more than its bound.
    chosen = compression_classifier.learnable(labels, "doc_id", "quality")
    hot = chosen.where("label = 1").orderBy(F.xxhash64("id"), "id").first()["id"]
    copy = F.explode(F.sequence(F.lit(1), F.lit(500)))
    many = docs.where(F.col("doc_id") == hot).withColumn("copy", copy).withColumn("text", F.concat_ws(" ", "text", "copy")).drop("copy")
    taken = compression_classifier.sample(docs.unionByName(many), chosen, 20, "text", "doc_id")
    classes = collections.Counter(y for _, y, _ in taken)
    assert 0 < classes[0] <= 40 and classes[1] == 40
    own = {r["text"] for r in docs.unionByName(many).where(F.col("doc_id") == hot).collect()}
    assert len(own) == 501 and sum(t in own for t, _, _ in taken) == 1
    again = compression_classifier.sample(many.unionByName(docs).repartition(7), chosen, 20, "text", "doc_id")
    assert taken == again
    model = compression_classifier.fit(docs, labels.where("false"))
    assert {r["score"] for r in compression_classifier.score(docs.limit(5), model).collect()} == {0.5}


def test_classifier_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = compression_classifier.fit(odd, labels)
    scores = [r["score"] for r in compression_classifier.score(odd, model).collect()]
    assert len(scores) == 12 and all(0 <= s <= 1 for s in scores)
    assert compression_classifier.score(nothing, model).count() == 0


# ---------------------------------------------------------------------------------- the pipeline


def test_pipeline_stages_follow_one_another(spark, docs, texts):
    given = docs
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        given = stage(spark, given, FOLDER).cache()
        frames[name] = given
    kept = {r["doc_id"]: r["text"] for r in frames["quality_rules"].collect()}
    book = {r["doc_id"] for r in quality_rules.ledger(docs).where(quality_rules.passes(quality_rules.STRICT)).collect()}
    assert set(kept) == book
    single = {r["doc_id"] for r in frames["ngram_jaccard_join"].collect()}
    assert single == {root for _, root in brute_components(kept).values()}
    clean = {r["doc_id"]: r["text"] for r in frames["personal_data"].collect()}
    assert set(clean) == single and not any(pii.base_spans(t) for t in clean.values())
    mixed = frames["mixing"].collect()
    assert {r["doc_id"] for r in mixed} <= single and len(mixed) > len(single)
    encoded = frames["bpe_encoding"].collect()
    assert sorted(r["doc_id"] for r in encoded) == sorted(r["doc_id"] for r in mixed)
    assert all(r["n_tokens"] == len(r["ids"]) for r in encoded)


def test_pipeline_of_odd_rows(spark, odd, nothing):
    for given in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            given = stage(spark, given, FOLDER)
            assert given.columns == list(corpus_pipeline.COLUMNS)
        corpus_pipeline.STAGES[-1][1](spark, given, FOLDER).collect()


def test_blocks_hash_words_by_content():
    data, offsets = blocks.text_bytes(pa.array(["Ab cd\tAb", None, "ab"]))
    words = blocks.Words(data, offsets)
    assert np.diff(words.bounds).tolist() == [3, 0, 1]
    plain, lower = words.hashes(), words.hashes(lower=True)
    assert plain[0] == plain[2] != plain[3] and lower[0] == lower[3]


def test_fitting_counts_every_candidate(spark, monkeypatch):
    rows = [(i, f"word {i} page{i} and password={i * 7919 + 10**11:x}q{i} follows") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = pii._all_cells
    counted = []
    monkeypatch.setattr(pii, "_all_cells", lambda d: counted.append((d.count(), got := whole(d))) or got)
    pii.fit(docs)
    (candidates, (cells, edges)) = counted[0]
    assert candidates > 400 and sum(cells.column("n").to_pylist()) == candidates
    # Fewer cells by merged bins still hold every candidate.
    monkeypatch.setattr(pii, "CELLS", 20)
    few, merged = whole(docs.sparkSession.createDataFrame(
        [([float(k), *[float((i * (j + 3)) % 97) for j in range(15)]], 1 - i % 3, i % 2, 5) for i in range(500) for k in (0, 4)],
        "form array<double>, told int, apart int, w long",
    ))
    assert sum(few.column("n").to_pylist()) == 1000 and max(map(len, merged[1:])) <= 1
