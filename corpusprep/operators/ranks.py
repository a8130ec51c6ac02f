"""Exact order statistics and positions without sorting all rows in one place.

Every function takes an ``order`` (columns that together are unique per row) and buckets: coarse
values that never decrease along that order, such as the leading digits of a hash, the file
split a line came from, or an equal-width range of ids. Rows are counted per bucket with map-side
combining, the running sum goes over the bucket table only, and only rows of the one bucket that
holds the wanted rank are ever sorted. Pick buckets so that both their number and the rows in one
are modest; the helpers below do that for hashes and integer ids.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Rank = int | Callable[[Column], Column]

HASH_BUCKET_DIGITS = 4
ID_RANGES = 65_536
ID_BLOCK_BITS = 16


def hash_buckets(hex_hash: Column) -> list[Column]:
    """65,536 even buckets of a hex hash."""
    return [F.substring(hex_hash, 1, HASH_BUCKET_DIGITS)]


def id_range(df: DataFrame, column: str) -> Column:
    """65,536 ranges of equal width between the least and the greatest value of a numeric id."""
    ends = df.select(F.struct(F.min(column).alias("least"), F.max(column).alias("greatest"))).scalar()
    spread = F.width_bucket(
        F.col(column).cast("double"), ends["least"].cast("double"), ends["greatest"].cast("double"), F.lit(ID_RANGES)
    )
    return F.coalesce(spread, F.lit(0))


def id_buckets(df: DataFrame, column: str) -> list[Column]:
    """Buckets of a unique integer id: equal ranges, then blocks of 65,536 ids inside one range.

    The ranges bound the bucket table for ids spread widely, the blocks bound the rows of one
    bucket for ids crowded together.
    """
    return [id_range(df, column), F.shiftright(F.col(column), ID_BLOCK_BITS)]


def sort_key(order: Sequence[Column]) -> Column:
    """One comparable value for an order of one or more columns."""
    if len(order) == 1:
        return order[0]
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])


def thresholds(df: DataFrame, order: Sequence[Column], buckets: Sequence[Column], ranks: Mapping[str, Rank]) -> Column:
    """The order keys found at the given ranks, as one scalar struct column with a field per name.

    A rank counts the rows wanted, so ``sort_key(order) <= thresholds(...)[name]`` keeps exactly
    that many: rank 0 gives null (nothing passes), a rank above the row count gives the last key. A
    rank may be a function of the row count. The caller's rows are not shuffled at all. Buckets are
    given from coarse to fine; a finer one divides the one coarse bucket that holds the rank.
    """
    levels = [f"_bucket{i}" for i in range(len(buckets))]
    keyed = df.select(*[b.alias(n) for b, n in zip(buckets, levels)], sort_key(order).alias("_key"))
    n_rows = F.count(F.lit(1)).alias("_rows")
    start = F.col("_upto") - F.col("_rows")
    holds_rank = (F.col("_rank") > start) & (F.col("_rank") <= F.col("_upto"))

    # The windows span the bucket table, not the rows.
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy(levels[0]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.col("_total")
    wanted = [
        F.struct(
            F.lit(name).alias("name"),
            F.least(total, (rank(total) if callable(rank) else F.lit(rank)).cast("bigint")).alias("rank"),
        )
        for name, rank in ranks.items()
    ]
    # One row per name: the bucket that holds its rank, and the rank inside that bucket.
    cuts = (
        keyed.groupBy(levels[0])
        .agg(n_rows)
        .withColumn("_upto", F.sum("_rows").over(upto))
        .withColumn("_total", F.sum("_rows").over(whole))
        .withColumn("_cut", F.explode(F.array(*wanted)))
        .withColumn("_rank", F.col("_cut.rank"))
        .filter(holds_rank)
        .select(levels[0], F.col("_cut.name").alias("_name"), (F.col("_rank") - start).alias("_rank"))
    )
    for i in range(1, len(levels)):
        upto = Window.partitionBy("_name").orderBy(levels[i]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cuts = (
            keyed.join(F.broadcast(cuts), levels[:i])
            .groupBy(*levels[: i + 1], "_name", "_rank")
            .agg(n_rows)
            .withColumn("_upto", F.sum("_rows").over(upto))
            .filter(holds_rank)
            .select(*levels[: i + 1], "_name", (F.col("_rank") - start).alias("_rank"))
        )
    found = (
        keyed.join(F.broadcast(cuts), levels)
        .withColumn("_at", F.row_number().over(Window.partitionBy("_name").orderBy("_key")))
        .filter(F.col("_at") == F.col("_rank"))
        .groupBy()
        .agg(*[F.max(F.when(F.col("_name") == name, F.col("_key"))).alias(name) for name in ranks])
    )
    return found.select(F.struct(*ranks)).scalar()


def with_position(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], bucket: Column, name: str = "position"
) -> DataFrame:
    """Add the 0-based position of each row inside its group.

    A group that holds a large part of all rows is still spread over its buckets: rows are sorted
    per (group, bucket), and the bucket table gives each bucket its offset.
    """
    keyed = df.withColumn("_bucket", bucket)
    counts = keyed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *group, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order)
    return (
        keyed.withColumn("_at", F.row_number().over(inside))
        .join(offsets, [*group, "_bucket"])
        .withColumn(name, (F.col("_offset") + F.col("_at") - 1).cast("bigint"))
        .drop("_bucket", "_at", "_offset")
    )
