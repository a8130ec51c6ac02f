"""Prefix scans over long tables of small summaries, one per file split or file, in blocks of blocks.

A window over a whole table, or over one very long file, puts all its rows into one task. Here rows are dealt
into ranges along their order; each range is scanned on its own, and so are the summaries of the ranges, of
which a segment has no more than ``MOST_BLOCKS``. What comes before a range is then added to its rows. That is
right for every associative way of combining; two are offered: sums, and the last value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.session import materialize

SUM, LAST = "sum", "last"
MOST_BLOCKS = 4096


def _over(how: str, name: str, window) -> Column:
    return F.sum(name).over(window) if how == SUM else F.last(name, ignorenulls=True).over(window)


def _joined(how: str, earlier: Column, later: Column) -> Column:
    return F.coalesce(earlier + later, earlier, later) if how == SUM else F.coalesce(later, earlier)


def before(
    rows: DataFrame, segment: Sequence[str], order: Sequence[str], combine: Mapping[str, str], blocks: int | None = None, folder: str | None = None
) -> DataFrame:
    """``rows`` with ``<name>_before`` for each name of ``combine``: the sum, or the last value that is not null, over
    all rows before it in its segment; null for the first.

    Segment and order are unique per row. Without ``segment`` the whole table is one. The rows are written twice, to
    count them and to freeze their ranges, under ``folder`` or the shared scratch folder.
    """
    if blocks is None:
        rows = materialize(rows, "scan-rows", folder)
        blocks = min(MOST_BLOCKS, max(1, isqrt(rows.count())))
    ranged = rows.repartitionByRange(blocks, *segment, *order).withColumn("_block", F.spark_partition_id())
    ranged = materialize(ranged, "scan-ranges", folder)
    along = Window.partitionBy(*segment, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumns({f"{name}_before": _over(how, name, along) for name, how in combine.items()})

    place = F.struct(*order) if order else F.lit(0)
    of_block = ranged.groupBy(*segment, "_block").agg(
        *[(F.sum(name) if how == SUM else F.max_by(F.col(name), F.when(F.col(name).isNotNull(), place))).alias(name) for name, how in combine.items()]
    )
    if segment:
        # A segment has no more rows here than there are blocks.
        along = Window.partitionBy(*segment).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        carried = of_block.select(*segment, "_block", *[_over(how, name, along).alias(f"{name}_carried") for name, how in combine.items()])
    else:
        # One row per block: they are told to each other as one list.
        listed = of_block.agg(F.sort_array(F.collect_list(F.struct("_block", *combine))).alias("_all"))
        each = F.transform("_all", lambda b, i: F.struct(b["_block"].alias("_block"), F.slice("_all", F.lit(1), i).alias("_earlier")))
        carried = listed.select(F.inline(each)).select(
            "_block", *[_folded(how, F.col("_earlier").getField(name), of_block.schema[name].dataType).alias(f"{name}_carried") for name, how in combine.items()]
        )
    joined = inside.join(carried, [*segment, "_block"])
    return joined.select(*rows.columns, *[_joined(how, F.col(f"{name}_carried"), F.col(f"{name}_before")).alias(f"{name}_before") for name, how in combine.items()])


def _folded(how: str, values: Column, kind) -> Column:
    known = F.filter(values, lambda v: v.isNotNull())
    if how == LAST:
        return F.try_element_at(known, F.lit(-1))
    total = F.aggregate(known, F.lit(0).cast(kind), lambda a, b: (a + b).cast(kind))
    return F.when(F.size(known) > 0, total)
