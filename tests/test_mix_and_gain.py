import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import sample, scoring


def by_walking(rows, weights, total=None, seed=42):
    """The kept ids, class by class in hash order, and the tokens of each share."""
    held = {c: sum(n or 0 for _, k, n in rows if k == c) for c in weights}
    largest = min(held[c] * 100 // w for c, w in weights.items())
    total = largest if total is None else min(total, largest)
    kept, got = set(), {}
    for c, w in weights.items():
        upto = 0
        for i, _, n in sorted((r for r in rows if r[1] == c), key=lambda r: hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest()):
            upto += n or 0
            if upto > total * w // 100:
                break
            kept.add(i)
            got[c] = upto
    return kept, got, total


@pytest.mark.parametrize("total", [None, 0, 500, 10**9])
def test_mix_by_tokens(spark, total):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hi", "hi", "en", "other"]), rng.choice([None, 0, 1, 30, 200])) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, language string, n long").repartition(5)
    weights = {"hi": 70, "en": 30}
    kept, got, whole = by_walking(rows, weights, total)
    assert {r.id for r in sample.mix_tokens(df, weights, "language", "n", ["id"], total).collect()} == kept
    for c, w in weights.items():
        assert whole * w // 100 - 200 < got.get(c, 0) <= whole * w // 100 or whole == 0


def test_mix_by_tokens_of_a_missing_class(spark):
    df = spark.createDataFrame([(1, "hi", 5)], "id long, language string, n long")
    assert sample.mix_tokens(df, {"hi": 50, "en": 50}, "language", "n", ["id"]).collect() == []
    with pytest.raises(ValueError):
        sample.mix_tokens(df, {"hi": 50, "en": 40}, "language", "n", ["id"])


def weight(replicate, group, i, seed=42):
    draw = int(hashlib.sha256(f"{seed}:{replicate}:{group}:{i}".encode()).hexdigest()[:8], 16) / 2**32
    total, term, n = 0.0, math.exp(-1), 0
    while True:
        total += term
        if draw < total:
            return n
        n += 1
        term /= n


def test_interval_of_a_gain(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), i, rng.random() < 0.5, rng.random() < 0.7) for i in range(200)] + [("zero", 1, False, True), ("one", 1, True, True)]
    df = spark.createDataFrame(rows, "category string, pos long, base boolean, tuned boolean").repartition(4)
    df = df.select("category", "pos", F.col("base").cast("int").alias("base"), F.col("tuned").cast("int").alias("tuned"))
    found = {r.category: r for r in scoring.gain_interval(df, ["category"], ["pos"], "base", "tuned", replicates=50).collect()}
    for category, r in found.items():
        own = [x for x in rows if x[0] == category]
        gains = []
        for replicate in range(51):
            w = [1 if replicate == 0 else weight(replicate, category, x[1]) for x in own]
            base, tuned = sum(a * x[2] for a, x in zip(w, own)), sum(a * x[3] for a, x in zip(w, own))
            gains.append(round((tuned - base) / base, 6) if base else None)
        known = sorted(g for g in gains[1:] if g is not None)
        cut = int(len(known) * 0.025)
        assert r.gain == gains[0] and r.low == (known[cut] if known else None) and r.high == (known[-1 - cut] if known else None)
        assert r.improves == bool(known and known[cut] > 0.05) and r.keeps == bool(known and known[cut] >= -0.02)
    assert found["zero"].gain is None and (found["one"].gain, found["one"].low, found["one"].high) == (0.0, 0.0, 0.0)


def test_gain_of_scores(spark):
    """From n-gram overlap to the gate."""
    rows = [(i, "the cat sat on the mat", "the cat", "the cat sat on the mat") for i in range(30)]
    df = spark.createDataFrame(rows, "id long, gold string, base string, tuned string")
    scores = [scoring.ngram_overlap(df, run, "gold", ["id"]).select("id", F.col("f1").alias(run)) for run in ("base", "tuned")]
    paired = scores[0].join(scores[1], "id").withColumn("metric", F.lit("rouge1"))
    r = scoring.gain_interval(paired, ["metric"], ["id"], "base", "tuned").first()
    assert r.gain == r.low == r.high == 1.0 and r.improves and r.keeps


def test_weights_are_a_poisson_variable():
    drawn = [weight(1, "a", i) for i in range(20_000)]
    assert abs(sum(drawn) / len(drawn) - 1) < 0.03
    assert [round(limit / 2**32, 9) for limit in scoring.POISSON_LIMITS[:3]] == [round(math.exp(-1) * x, 9) for x in (1, 2, 2.5)]
