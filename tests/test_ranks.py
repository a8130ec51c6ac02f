import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import ranks, sample, split


@pytest.mark.parametrize("n", [0, 1, 2, 3, 9, 10, 11, 64, 1003])
def test_split_sizes_are_exact(spark, n):
    df = split.exact(spark.range(n), ["id"])
    got = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    a, b = int(n * 0.8), int(n * 0.9)
    want = {"train": a, "val": b - a, "test": n - b}
    assert got == {k: v for k, v in want.items() if v}


def test_split_is_stable_under_partitioning(spark):
    def train(parts):
        df = split.exact(spark.range(500).repartition(parts), ["id"])
        return {r.id for r in df.filter("split = 'train'").collect()}

    assert train(1) == train(4) == train(13)


def test_split_depends_on_seed(spark):
    picked = [{r.id for r in split.exact(spark.range(300), ["id"], seed=s).filter("split = 'val'").collect()} for s in (1, 2)]
    assert picked[0] != picked[1]


def test_holdout(spark):
    got = split.exact(spark.range(101), ["id"], cuts=split.HOLDOUT_CUTS, names=split.HOLDOUT).filter("split = 'train'").count()
    assert got == int(101 * 0.95)


ID_SETS = {
    "dense": list(range(500)),
    "sparse": [x * 10**12 - 7 for x in range(300)],
    "outlier": [*range(400), 2**62],
    "crowded": [*range(200), *range(10**15, 10**15 + 200)],
    "negative": list(range(-100, 100)),
    "one": [5],
    "none": [],
}


@pytest.mark.parametrize("ids", ID_SETS, ids=str)
@pytest.mark.parametrize("k", [0, 1, 37, 10_000, None])
def test_first_k(spark, ids, k):
    values = ID_SETS[ids]
    shuffled = random.Random(1).sample(values, len(values))
    df = spark.createDataFrame([(v,) for v in shuffled], "id bigint").repartition(5)
    got = sorted(r.id for r in sample.first_k(df, k, ["id"]).collect())
    assert got == (sorted(values) if k is None else sorted(values)[:k])


@pytest.mark.parametrize("k", [0, 1, 40, 500, None])
def test_fixed_size_sample(spark, k):
    df = spark.range(200)
    rows = {r.id for r in sample.fixed_size(df, k, ["id"]).collect()}
    assert len(rows) == (200 if k is None else min(k, 200))
    assert rows == {r.id for r in sample.fixed_size(df.repartition(7), k, ["id"]).collect()}


def test_first_k_per_group_with_a_hot_group(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("g"), "id")
    got = {}
    for r in sample.first_k_per_group(df, 4, ["g"], ["id"]).collect():
        got.setdefault(r.g, []).append(r.id)
    want = {}
    for i in range(3000):
        want.setdefault(i % 50 if i % 3 == 0 else -1, []).append(i)
    assert {g: sorted(v) for g, v in got.items()} == {g: v[:4] for g, v in want.items()}


def test_positions_in_a_hot_group(spark):
    rows = [(i * 17 % 4001, "hot" if i % 4 else f"g{i % 7}") for i in range(1500)]
    df = spark.createDataFrame(rows, "id bigint, g string")
    placed = ranks.with_position(df, ["g"], [F.col("id")], ranks.id_range(df, "id"))
    want = {}
    for g in {g for _, g in rows}:
        for at, i in enumerate(sorted(i for i, h in rows if h == g)):
            want[i] = at
    assert {r.id: r.position for r in placed.collect()} == want


def test_no_row_shuffle_for_a_split(spark):
    """The rows meet only scalar cut hashes: above the scan there is no exchange and no join."""
    df = split.exact(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), ["doc_id"])
    plan = df._jdf.queryExecution().sparkPlan()
    assert [plan.getClass().getSimpleName(), plan.children().head().getClass().getSimpleName()] == ["ProjectExec", "FileSourceScanExec"]
