import random

import pytest
from pyspark.sql import functions as F

from corpusprep.functions.filters import maybe_in, words_for
from corpusprep.operators import containment, scoring

PASSAGES = [
    (1, "the quick brown fox jumps over"), (2, "Two\tWORDS"), (3, "one"), (4, None), (5, " \n "), (6, "never said by any of these texts"),
    (7, "the quick brown fox jumps over"), (None, "two words"), (8, "ab c d e f"), (9, "a b c d e f g"), (9, "two words"),
]
TEXTS = [
    (1, "so THE quick  brown\nfox jumps over it"), (2, "the quick brown fox jumps overland"), (3, "two words, two words"), (4, "two words"), (5, None), (6, ""),
    (7, "one"), (8, "someone said phone"), (None, "one two words"), (9, "xab c d e f"), (9, "x ab c d e f"), (10, "a b c d e f　g"),
]


def by_looking(texts, passages):
    cut = lambda t: f" {' '.join((t or '').lower().split())} "
    return sorted({(p, t) for p, a in passages for t, b in texts if p is not None and t is not None and cut(a) != "  " and cut(a) in cut(b)})


def found(spark, texts, passages, **bounds):
    t = spark.createDataFrame([(*r, "x", 1) for r in texts], "doc_id long, text string, words string, gram int").repartition(3)
    p = spark.createDataFrame([(*r, "y") for r in passages], "item_id long, text string, passage string")
    return sorted(tuple(r) for r in containment.contained(t, p, "doc_id", "item_id", **bounds).collect())


@pytest.mark.parametrize("gram_words", [1, 3, 5, 50])
def test_odd_rows(spark, gram_words):
    assert found(spark, TEXTS, PASSAGES, gram_words=gram_words) == by_looking(TEXTS, PASSAGES)


def test_against_looking_everywhere(spark):
    rng = random.Random(3)
    # Few words, so that all n-grams are frequent, and one passage in a third of the texts.
    text = lambda n: " ".join(rng.choice("aab") for _ in range(n))
    hot = "a b a b a a b b"
    texts = [(i, text(rng.randint(0, 40)) + (f" {hot}" if i % 3 == 0 else "")) for i in range(300)]
    passages = [(i, text(rng.randint(1, 9))) for i in range(40)] + [(40, hot)]
    assert found(spark, texts, passages) == by_looking(texts, passages)


@pytest.mark.parametrize("texts, passages", [([], PASSAGES), (TEXTS, []), (TEXTS, [(4, None)])])
def test_nothing_to_find(spark, texts, passages):
    assert found(spark, texts, passages) == []


def test_no_pairs_are_made_without_a_key(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plan = containment.contained(documents, benchmark, "doc_id", "item_id")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filter_passes_all_that_match(spark):
    rows = spark.range(5000)
    keys = spark.range(0, 5000, 50).withColumnRenamed("id", "key")
    passed = {r.id for r in maybe_in(rows, "id", keys, "key").collect()}
    assert set(range(0, 5000, 50)) <= passed and len(passed) < 1000
    assert words_for(10**12) == words_for(10**15)


def plain_grams(text, n):
    w = (text or "").lower().split()
    return [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]


def test_gram_counts(spark):
    rng = random.Random(4)
    text = lambda: rng.choice([None, "", "a", " ".join(rng.choice("aAbc") for _ in range(rng.randint(1, 30)))])
    rows = [(i, text(), text()) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, said string, wanted string").repartition(3)
    got = {(r.id, r.n): (r.n_candidate, r.n_reference, r.n_common) for r in scoring.gram_counts(df, "said", "wanted", ["id"], [1, 2, 4]).collect()}
    for i, said, wanted in rows:
        for n in (1, 2, 4):
            a, b = plain_grams(said, n), plain_grams(wanted, n)
            assert got[i, n] == (len(a), len(b), sum(min(a.count(g), b.count(g)) for g in set(a)))


def test_gram_counts_move_no_grams(spark):
    """Rows with ids of their own are counted where they are; ids that come twice, or not at all, are counted together."""
    rng = random.Random(6)
    text = lambda: rng.choice([None, " ", "a b", " ".join(rng.choice(["a", "É", "b", "中", "a\u3000c"]) for _ in range(rng.randint(1, 30)))])
    rows = [(i, text(), text()) for i in range(150)]
    for extra in ([], [(None, "a b a", "a b"), (None, "b", "a a b"), (7, "a b c", "c a b"), (7, "a b c", "c a b")]):
        df = spark.createDataFrame(rows + extra, "id long, said string, wanted string").repartition(3)
        counts = scoring.gram_counts(df, "said", "wanted", ["id"], [1, 3], slice_rows=16)
        if not extra:
            assert "Aggregate" not in counts._jdf.queryExecution().optimizedPlan().toString()
        got = {(r.id, r.n): (r.n_candidate, r.n_reference, r.n_common) for r in counts.collect()}
        assert counts.count() == len(got) == 2 * len({i for i, _, _ in rows + extra})
        for i in {i for i, _, _ in rows + extra}:
            for n in (1, 3):
                a, b = ([g for r in rows + extra if r[0] == i for g in plain_grams(r[side], n)] for side in (1, 2))
                assert got[i, n] == (len(a), len(b), sum(min(a.count(g), b.count(g)) for g in set(a)))


def test_words_are_cut_once_for_all_lengths(spark):
    df = spark.createDataFrame([(1, "a b", "b a")], "id long, said string, wanted string")
    plan = scoring.gram_counts(df, "said", "wanted", ["id"], [1, 2, 3, 4])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2


def test_bleu(spark):
    schema = "id long, said string, wanted string"
    same = spark.createDataFrame([(1, "the cat sat on the mat", "the cat sat on the mat")], schema)
    assert scoring.corpus_bleu(same, "said", "wanted", ["id"]).first().bleu == 1.0
    # 5 of 6, 3 of 5, 1 of 4 words in a row: no four, so that only up to three counts.
    near = spark.createDataFrame([(1, "the cat sat on a mat", "the cat sat in a mat")], schema)
    assert scoring.corpus_bleu(near, "said", "wanted", ["id"]).first().bleu == 0.0
    want = round(((5 / 6) * (3 / 5) * (1 / 4)) ** (1 / 3), 6)
    assert scoring.corpus_bleu(near, "said", "wanted", ["id"], 3).first().bleu == want
    assert scoring.corpus_bleu(near.limit(0), "said", "wanted", ["id"]).first().bleu == 0.0
