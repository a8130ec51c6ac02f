import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import pairs, scan


def plain(rows):
    """What comes before each (segment, place, n, mark), in order."""
    sums, marks, out = {}, {}, {}
    for segment, place, n, mark in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        out[segment, place] = (sums.get(segment), marks.get(segment))
        if n is not None:
            sums[segment] = (sums.get(segment) or 0) + n
        marks[segment] = mark if mark is not None else marks.get(segment)
    return out


@pytest.mark.parametrize("blocks", [None, 1, 7, 200])
def test_scan_by_segment(spark, blocks):
    rng = random.Random(2)
    rows = [(rng.choice("aaaaaab"), i, rng.choice([None, 1, 5]), rng.choice([None, None, f"m{i}"])) for i in range(600)]
    df = spark.createDataFrame(rows, "segment string, place int, n long, mark string").repartition(5)
    got = {(r.segment, r.place): (r.n_before, r.mark_before) for r in scan.before(df, ["segment"], ["place"], {"n": scan.SUM, "mark": scan.LAST}, blocks).collect()}
    assert got == plain(rows)


@pytest.mark.parametrize("blocks", [None, 1, 40])
def test_scan_of_a_whole_table(spark, blocks):
    rng = random.Random(3)
    rows = [("", i, rng.choice([None, 2, 3]), rng.choice([None, "x", "y"])) for i in range(400)]
    df = spark.createDataFrame(rows, "segment string, place int, n long, mark string").repartition(5)
    found = scan.before(df, [], ["place"], {"n": scan.SUM, "mark": scan.LAST}, blocks)
    assert {("", r.place): (r.n_before, r.mark_before) for r in found.collect()} == plain(rows)
    assert scan.before(df.limit(0), [], ["place"], {"n": scan.SUM}).collect() == []


def test_no_window_spans_the_table(spark):
    df = spark.range(1000).withColumn("n", F.lit(1))
    plan = scan.before(df, [], ["id"], {"n": scan.SUM})._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window" in line]
    assert windows and all("_block" in line.split("windowspecdefinition(")[1].split("id#")[0] for line in windows)


def test_pairs_over_five_thousand_splits_of_one_file(spark):
    rng = random.Random(4)
    rows, want, held = [], [], None
    for i in range(15_000):
        kind, body = rng.choice(["EN", "HI"]), rng.choice(["", f"text {i}", f"text {i}"])
        if i // 3 % 10 == 7:  # splits without markers
            continue
        rows.append(("one file", i // 3, i, kind, body))
        if kind == "EN":
            held = body or None
        else:
            if held and body:
                want.append((i, held, body))
            held = None
    df = spark.createDataFrame(rows, "src_file string, src_block long, src_row long, kind string, body string").repartition(9)
    found = pairs.pair_markers(df, ["src_file"], "src_block", "src_row")
    assert sorted((r.src_row, r.en, r.hi) for r in found.collect()) == want
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()
