import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import pairs
from corpusprep.plans.catalog import TURN_BLOCK_BITS
from corpusprep.sources import ingest


def by_lines(spark, *paths):
    return [(r.en, r.hi) for r in pairs.pair_lines(ingest.lines(spark, list(paths))).orderBy(*ingest.ORDER).collect()]


def by_splits(spark, *paths):
    return [(r.en, r.hi) for r in pairs.read_pairs(spark, list(paths)).orderBy(*ingest.ORDER).collect()]


READERS = pytest.mark.parametrize("read", [by_lines, by_splits])


@READERS
def test_rules(spark, tmp_path, lines_file, read):
    lines = [
        "HI: no partner", "EN: one", "HI: ek", "EN: dropped", "EN: two", "HI: do", "HI: extra", "EN: three", "HI:", "HI: late",
        "EN:", "HI: empty partner", "  EN:  four  ", "junk", "", "\tHI:　चार  ", "EN: five", "EN:", "HI: none", "en: x", "EN: end",
    ]
    path = lines_file(tmp_path / "p.txt", lines)
    assert read(spark, path) == [("one", "ek"), ("two", "do"), ("four", "चार")]


def scripted(rng, n):
    """Lines made of stretches whose pairs are known, and those pairs; no stretch leaves an EN waiting."""
    lines, found = [], []
    for i in range(n):
        en, hi = f"text {i}", f"पाठ {i} " + "क" * rng.randint(1, 60)
        stretch, pairs_in_it = rng.choice(
            [
                ([f"EN: {en}", f"HI: {hi}"], [(en, hi)]),
                ([f"EN: {en}", "junk", "", f"  HI:{hi}"], [(en, hi)]),
                (["EN: replaced", f"EN: {en}", f"HI: {hi}"], [(en, hi)]),
                ([f"EN: {en}", f"HI: {hi}", "HI: extra"], [(en, hi)]),
                ([f"EN: {en}", "HI:", "HI: too late"], []),
                (["EN:", f"HI: {hi}"], []),
                (["EN: forgotten", "EN:", "HI: alone"], []),
                (["HI: alone"], []),
                (["junk " * 20], []),
            ]
        )
        lines += stretch
        found += pairs_in_it
    return [*lines, "EN: at the end"], found


@pytest.mark.parametrize("seed", range(3))
@READERS
def test_random_files_cut_into_many_splits(spark, tmp_path, lines_file, small_splits, seed, read):
    rng = random.Random(seed)
    files = [scripted(rng, n) for n in (300, 3, 200)]
    paths = [lines_file(tmp_path / f"{i}.txt", lines) for i, (lines, _) in enumerate(files)]
    assert ingest.lines(spark, paths).select("src_block").distinct().count() > 5
    assert read(spark, *paths) == [p for _, found in files for p in found]


@READERS
def test_stretches_without_markers_span_splits(spark, tmp_path, lines_file, small_splits, read):
    lines = ["EN: far"] + ["junk " + "j" * 100] * 100 + ["HI: दूर", "HI: extra"] + ["x" * 90] * 60 + ["EN: a", "EN: b"] + ["y" * 50] * 80 + ["HI: ख"]
    assert read(spark, lines_file(tmp_path / "far.txt", lines)) == [("far", "दूर"), ("b", "ख")]


HEADS = [
    (["EN: a", "HI: क"], [("a", "क")]),
    (["EN:EN: a", "HI: क", "EN:EN: b", "HI: ख"], [("EN: a", "क"), ("EN: b", "ख")]),
    (["title", "HI: no", "EN: a", "HI: क"], [("a", "क")]),
    (["", "EN: a", "HI: क"], [("a", "क")]),
    (["HI: no", "EN:title", "HI: क"], [("title", "क")]),
    (["  EN: indented", "HI: क", " EN: b", "EN: c", "HI: ग"], [("indented", "क"), ("c", "ग")]),
    (["junk"], []),
    (["EN: only"], []),
    (["EN:", "HI: none"], []),
    (["EN: mac\rHI: ends\rEN: and\rHI: more", "EN: dos\r", "HI: lines\r", "\r"], [("mac", "ends"), ("and", "more"), ("dos", "lines")]),
]


@READERS
def test_how_files_begin(spark, tmp_path, lines_file, read):
    paths = [lines_file(tmp_path / f"{i}.txt", lines) for i, (lines, _) in enumerate(HEADS)]
    assert read(spark, *paths) == [p for _, found in HEADS for p in found]


@READERS
def test_file_without_markers_at_line_starts(spark, tmp_path, lines_file, small_splits, read):
    path = lines_file(tmp_path / "none.txt", ["en: lower case", "x EN: inside"] * 3000)
    assert read(spark, path) == []


def test_pairs_of_a_split_need_no_shuffle(spark, tmp_path, lines_file):
    path = lines_file(tmp_path / "p.txt", ["EN: a", "HI: क"])
    assert "Exchange" not in pairs.split_candidates(spark, path)._jdf.queryExecution().executedPlan().toString()


def test_one_source_with_most_rows(spark):
    rng = random.Random(3)
    rows = [("big" if i % 3 else f"s{i % 5}", i, rng.choice(["EN", "HI"]), f"t{i}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "s string, at bigint, kind string, body string").withColumn("b", F.shiftright("at", 8))
    got = {(r.s, r.en, r.hi) for r in pairs.pair_markers(df, ["s"], "b", "at").collect()}
    want = set()
    for source in {r[0] for r in rows}:
        own = [(kind, text) for s, _, kind, text in rows if s == source]
        want |= {(source, en, hi) for (a, en), (b, hi) in zip(own, own[1:]) if (a, b) == ("EN", "HI")}
    assert got == want


def test_markers_are_read_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select(
        "conv_id", "turn", F.shiftright("turn", TURN_BLOCK_BITS).alias("b"), F.upper("role").alias("kind"), F.col("text").alias("body")
    )
    plan = pairs.pair_markers(df, ["conv_id"], "b", "turn")._jdf.queryExecution().executedPlan().toString()
    # Both halves go on from what was written, and nothing meets in one task.
    assert "conversations" not in plan and "SinglePartition" not in plan


def with_lengths(df):
    return df.withColumn("en_chars", F.length("en")).withColumn("hi_chars", F.length("hi"))


@pytest.mark.parametrize("n, kept", [(99, False), (100, True), (8000, True), (8001, False)])
def test_story_lengths(spark, n, kept):
    df = with_lengths(spark.createDataFrame([(1, "en", "क" * n)], "id bigint, en string, hi string"))
    assert pairs.stories(df, 5, ["id"]).count() == kept


@pytest.mark.parametrize("n, kept", [(59, False), (60, True), (1500, True), (1501, False)])
def test_pair_lengths(spark, n, kept):
    ok = "x" * 60
    df = spark.createDataFrame([(1, ok, "क" * n), (2, "e" * n, ok)], "id bigint, en string, hi string")
    df = with_lengths(df)
    assert pairs.eligible(df).count() == 2 * kept


def test_stories_keep_file_order(spark, tmp_path, lines_file, small_splits):
    lines = [x for i in range(60) for x in (f"EN: {i}", "HI: " + f"{i} " * 60)]
    paired = pairs.read_pairs(spark, lines_file(tmp_path / "s.txt", lines))
    got = pairs.stories(paired, 17, ingest.ORDER, [ingest.split()])
    assert [r.text.split()[0] for r in got.orderBy(*ingest.ORDER).collect()] == [str(i) for i in range(60) if len(f"{i} " * 60) >= 100][:17]


def test_translation_sample(spark):
    df = spark.createDataFrame([(i, f"{i} " * 40, f"{i}क" * 40) for i in range(200)], "id bigint, en string, hi string")
    df = with_lengths(df)
    rows = pairs.translation_sample(df, ["id"], 50).collect()
    assert len(rows) == 50 and len({r.id for r in rows}) == 50
    assert {r.language for r in rows} == {"hindi_translation"}
    assert {r.instruction for r in rows} == set(pairs.TRANSLATE_INSTRUCTIONS)
    assert all(r.input.split()[0] == r.output.split("क")[0] == str(r.id) for r in rows)
    assert {r.id for r in rows} == {r.id for r in pairs.translation_sample(df.repartition(9), ["id"], 50).collect()}
