"""Conversation repair, token counts and fill-in-the-middle against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusprep.llm import fim, token_count, turn_repair
from corpusprep.llm.common import on_workers

JSON = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"


# Token counts


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(JSON)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


PARTS = [
    "'", "'s", "'re", "'ve", "'ll", "'d", "'r", "'l", "'v", "'S", " ", "  ", "\n", "\t", " a", "a", "b", "re", "ll", "ved", "1", "23", "!", "?!", "é", "漢", "՘",
    "🎉", "\0", "<|endoftext|>", "<|endof", "x" * 50, "　", "\x1c", "\x85", "İ", "ß", " the", "'é", "​", "é", "٣", "Ⅷ",
]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("bounds", [{}, {"block": 7}, {"block": 300, "words": 20}, {"block": 1}])
def test_token_counts_are_the_library_s(library, bounds):
    texts = odd_texts(800) + ["x" * 9000 + " " * 600 + "'ll" * 300, "", "ab" * 4000]
    counter = token_count.compiled(JSON)
    for name, value in bounds.items():
        setattr(counter, "most_words" if name == "words" else name, value)
    assert counter.count(texts).tolist() == library(texts)


def test_token_counts_when_states_are_dropped(library):
    counter = token_count.compiled(JSON)
    counter.counter.max_states, counter.most_words = 50, 0
    texts = odd_texts(200, 2) + ["thequickbrownfox" * 600]
    assert counter.count(texts).tolist() == library(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_token_counts_of_any_text(texts):
    if not hasattr(test_token_counts_of_any_text, "made"):
        test_token_counts_of_any_text.made = token_count.compiled(JSON), Tokenizer.from_file(JSON)
    counter, tokenizer = test_token_counts_of_any_text.made
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert counter.count(texts).tolist() == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_scan_over_chunk_maps_is_a_reading_from_the_start():
    rng = np.random.default_rng(3)
    for size, width in ((1, 256), (255, 16), (1000, 16), (5000, 37)):
        kinds = rng.integers(0, token_count.END + 1, size).astype(np.uint8)
        for first in range(token_count.STATES):
            marks, end = token_count.marks_of(kinds, first, width)
            state, want = first, []
            for kind in kinds.tolist():
                want.append(int(token_count.MARKS[state * 16 + kind]))
                state = int(token_count.NEXT[state * 16 + kind])
            assert marks.tolist() == want and end == state


def test_counts_along_a_path_are_those_of_every_prefix():
    counter = token_count.compiled(JSON).counter
    for word in (b" international", b"xxxxxxxxxxxx", " Größe".encode(), b"antidisestablishmentarianism"):
        for n in range(len(word) + 1):
            assert counter.count(word[:n]) == len(counter.merged(word[:n]))


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_count.compiled(public_tokenizers.path("word_bpe_49k.json"))


def test_token_counts_of_the_table(spark, library):
    on_workers(spark)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(3)
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    want = dict(zip(texts, library(list(texts.values()))))
    rows = token_count.count(documents, JSON).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.id].encode()), want[r.id], want[r.id] > 1024)


# Boundary sets and fill-in-the-middle


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 400_000), max_size=300), st.lists(st.tuples(st.integers(0, 300_000), st.integers(1, 30_000)), max_size=3))
def test_boundary_set_selects_what_a_sorted_list_holds(single, runs):
    values = np.array(sorted(single.union(*(range(a, a + n) for a, n in runs))), np.int64)
    held = fim.BoundarySet(values)
    assert len(held) == len(values)
    assert held.select(np.arange(len(values))).tolist() == values.tolist()
    with pytest.raises(IndexError):
        held.select([len(values)])


def test_each_container_is_chosen_where_it_is_smallest():
    rng = np.random.default_rng(0)
    sparse = np.sort(rng.choice(fim.SPAN, 1000, replace=False))
    dense = np.sort(rng.choice(fim.SPAN, 30_000, replace=False))
    kinds = [type(c) for c in fim.BoundarySet(np.concatenate([sparse, fim.SPAN + dense, 2 * fim.SPAN + np.arange(60_000)])).containers]
    assert kinds == [fim.ArrayContainer, fim.BitmapContainer, fim.RunContainer]


def plain_fim(doc_id, text, seed=7, percent=100, spm=50):
    """(n, form, prefix, middle, suffix) by a regular expression."""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    plain = not text or any(m in text for m in fim.MARKERS) or h[2] % 100 >= percent
    return n, "plain" if plain else "spm" if h[3] % 100 < spm else "psm", "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])


FIM_ROWS = [
    (1, "one\ntwo\nthree"), (2, None), (3, ""), (4, "\n"), (5, "\n\n\n"), (6, "no line feed"), (7, "has <S> inside\nand more"), (8, "<<S<P\n<\nM>\n>S>\n" * 30),
    (9, "é漢🎉\n" * 70_000), (None, "without id\n" * 5), (None, None), (1, "one\ntwo\nthree"), (10, "a\r\nb\rc d\x0be\x0cf\n"), (11, "x" * 70_000), (12, "\n" * 70_000),
    *((i, "".join(f"line {j} <" + "\n" * (j % 3) for j in range(i % 50))) for i in range(100, 200)),
]


@pytest.mark.parametrize("percent", [100, 40])
def test_fill_in_middle(spark, percent):
    on_workers(spark)
    docs = spark.createDataFrame([(*r, "x", "y") for r in FIM_ROWS], "doc_id long, text string, n string, form string").repartition(3)
    made = fim.transform(docs, percent=percent)
    rows = made.select("doc_id", "text", "n", "fim.*", fim.restored(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
    assert len(rows) == len(FIM_ROWS)
    forms = set()
    for r in rows:
        text = r.text or ""
        n, form, prefix, middle, suffix = plain_fim(r.doc_id, text, percent=percent)
        forms.add(form)
        assert r["form"] == form and r[3] == n and r.back == text
        if form == "plain":
            assert r.output == text and r.prefix_chars is None and r.middle_chars is None
        else:
            assert (r.prefix_chars, r.middle_chars) == (len(prefix), len(middle))
            assert r.output == {"psm": f"<P>{prefix}<S>{suffix}<M>{middle}", "spm": f"<S>{suffix}<P>{prefix}<M>{middle}"}[form]
    assert forms == {"plain", "psm", "spm"}


def test_fill_in_middle_by_characters(spark):
    on_workers(spark)
    docs = spark.createDataFrame([(i, "é" * i + "xyz") for i in range(30)], "doc_id long, text string")
    for r in fim.transform(docs, unit="character").select("doc_id", "text", "fim.*", fim.restored(F.col("fim.output"), F.col("fim.form")).alias("back")).collect():
        assert r.back == r.text and r.n == len(r.text)


def test_fill_in_middle_of_nothing(spark):
    on_workers(spark)
    assert fim.transform(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("markers", [("<P>", "<P>", "<M>"), ("<P>", "<PP>x<P>", "<M>"), ("ab", "ba", "c"), ("aa", "b", "c"), ("", "b", "c")])
def test_markers_that_could_be_mistaken_are_refused(spark, markers):
    with pytest.raises(ValueError):
        fim.transform(spark.createDataFrame([], "doc_id long, text string"), markers=markers)


def test_column_of_the_result_must_be_free(spark):
    with pytest.raises(ValueError):
        fim.transform(spark.createDataFrame([], "doc_id long, text string, fim string"))


# Conversation repair


def cheapest(rows):
    """(cost, edits, lines) by trying every sequence of edits; rows are (role, text, deleted, truncated)."""
    best = None
    ways = [[""] if r[2] else ["", *(f"{i}{e}" for i in ("", "I") for e in ("K", "Ru", "Ra"))] for r in rows]
    for way in itertools.product(*ways):
        for end in ("", "I", "II"):
            cost, edits, lines, shape = 5 * len(end), "", [], ""
            possible = True
            for (role, text, _, truncated), edit in zip(rows, way):
                if not edit:
                    cost, edits = cost + 2, edits + "D"
                    continue
                own = role if "K" in edit else {"Ru": "user", "Ra": "assistant"}[edit.lstrip("I")]
                if edit[0] == "I":
                    other = "assistant" if own[:1] == "u" else "user"
                    cost, lines, shape = cost + 5, [*lines, other + ":"], shape + other[0]
                cost += (0 if "K" in edit else 1) + (5 if truncated else 0)
                edits, lines, shape = edits + edit[: 1 + (edit[0] == "I")], [*lines, f"{own}:{text}"], shape + (own[:1] or "?")
            for _ in end:
                other = "assistant" if shape[-1:] == "u" else "user"
                lines, shape = [*lines, other + ":"], shape + other[0]
            edits += end
            if possible and re.fullmatch(r"(s?(ua)+)?", shape) and (best is None or (cost, edits) < best[:2]):
                best = cost, edits, lines
    return best


def test_repair_is_the_cheapest_of_all_edits():
    rng = random.Random(5)
    repair = turn_repair.Repair(block=8)
    for _ in range(250):
        roles = rng.choice((["user", "assistant"], ["system", "user", "assistant", "tool", "", "umpire"]))
        rows = [(rng.choice(roles), f"t{i}", rng.random() < 0.15, rng.random() < 0.3) for i in range(rng.randint(0, 5))]
        repair.begin()
        for row in rows:
            repair.turn(*row)
        cost, edits, lines = cheapest(rows)
        assert repair.end() == (cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(key.encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


TURNS = [
    *((c, t, ("user", "assistant")[t % 2], f"turn {t} of {c}.") for c in range(40) for t in range(c % 7)),
    (100, None, "system", "no number."), (100, 1, None, None), (100, 1, "user", "hi"), (100, 9, "assistant", "  \t"), (100, 9, "user", "hi"),
    (None, 1, "user", "who?"), (None, 2, "assistant", "me. \n"), (None, None, "tool", "x"), (200, 5, "user", ""), (300, 1, "user", "same."), (300, 1, "user", "same."),
    (400, -3, "", "no role."), (400, 3, "assistant", "y" * 20_000 + "."), (2**60 + 1, 1, "user", "large id."), (2**60 + 2, 1, "user", "large id."),
]


@pytest.fixture(scope="module")
def turns(spark):
    on_workers(spark)
    return spark.createDataFrame([(*r, "x", "y") for r in TURNS], "conv_id long, turn long, role string, text string, fault string, conv string").repartition(5)


def test_audit(turns):
    found = {r.conv: r for r in turn_repair.audit(turn_repair.damaged(turns), block=8).collect()}
    assert set(found) == {r[0] for r in TURNS} and turn_repair.damaged(turns).count() >= len(TURNS)
    after = plain_damage(TURNS)
    for conv, r in found.items():
        own = sorted((t for t in after if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2], t[3]))
        seen, rows, faults = set(), [], []
        for _, _, role, text in own:
            said = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            rows.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        numbers = [t[1] for t in own if t[1] is not None]
        assert r.gaps == (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0)
        assert [r.blank, r.duplicate, r.truncated] == [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        assert r.illegal == sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, edits, lines = cheapest(rows)
        assert (r.cost, r.audit, r.repaired_sha256) == (cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_repaired_turns_are_those_of_the_audit(turns):
    after = turn_repair.undamaged(turns)
    lines = {}
    for r in sorted(turn_repair.repaired(after, in_memory=100).collect(), key=lambda r: r.place):
        assert r.place == len(lines.setdefault(r.conv, []))
        lines[r.conv].append(f"{r.role}:{r.text}")
    for r in turn_repair.audit(after).collect():
        own = lines.get(r.conv, [])
        assert hashlib.sha256("\n".join(own).encode()).hexdigest() == r.repaired_sha256
        assert re.fullmatch(r"(s?(ua)+)?", "".join(line[0] for line in own))


def test_a_giant_conversation_is_streamed(spark):
    on_workers(spark)
    n = 30_000
    rows = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.col("id") % (n - 5), F.lit(".")).alias("text"),
    ).repartition(7)
    (r,) = turn_repair.audit(turn_repair.undamaged(rows), block=4096).collect()
    repair = turn_repair.Repair()
    for i in range(n):
        repair.turn(("user", "assistant")[i % 2], f"t{i % (n - 5)}.", False, False)
    # The last five repeat the role too only where n - 5 is even: here they differ.
    assert r.duplicate == 0 and (r.cost, r.audit, r.repaired_sha256) == repair.end() and r.audit == "K" * n


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.audit(turn_repair.damaged(none)).collect() == []
    assert turn_repair.repaired(turn_repair.undamaged(none)).collect() == []
