"""Sharding by a weighted hash tree: region, rack, shard.

A row descends the tree. At each level every child draws ``-ln(u) / weight`` with ``u`` hashed from the
row's key and the child's name, and the smallest draw wins; a child's weight is the sum of the
weights below it. A change of weights moves rows only into or out of the subtrees whose weights
change. A shard that joins under a region of its own therefore takes rows into itself and moves no
other row. Placement is one expression per row: nothing is shuffled or looked up.

Defined results: a null text has no bytes, its size is 1 and its checksum that of the empty text.
A null id is a key like any other. Repeated rows get the same shard and slots of their own. Extra
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import text_or_empty
from corpusprep.session import materialize


@dataclass(frozen=True)
class Shard:
    """One leaf of the tree. Weight 0 takes no rows."""

    region: str
    rack: str
    number: int
    weight: float = 1.0


def balanced(count: int, per_rack: int = 2, per_region: int = 4) -> list[Shard]:
    """``count`` shards of equal weight in racks of ``per_rack`` and regions of ``per_region``."""
    return [Shard(f"r{i // per_region}", f"k{i // per_rack}", i) for i in range(count)]


def joined(shards: list[Shard], number: int, weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, under a region of its own."""
    return [*shards, Shard(f"r+{number}", f"k+{number}", number, weight)]


def _draw(key: list[Column], level: str, child: Column, weight: Column) -> Column:
    # 53 bits of the hash make a double that is never 0 or 1.
    bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(level), child), 11)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / weight


def _pick(key: list[Column], level: str, children: Column) -> Column:
    """The child (name, weight) of the smallest draw."""
    draws = F.transform(children, lambda c: F.struct(_draw(key, level, c["name"], c["weight"]).alias("draw"), c["name"].alias("name")))
    return F.array_min(draws)["name"]


def _children(weights: dict) -> Column:
    return F.array(*(F.struct(F.lit(name).alias("name"), F.lit(float(w)).alias("weight")) for name, w in weights.items() if w > 0))


def place(key: list[Column], shards: list[Shard]) -> Column:
    """The number of the shard that takes a row with this key."""
    regions: dict = {}
    racks: dict = {}
    leaves: dict = {}
    for s in shards:
        regions[s.region] = regions.get(s.region, 0) + s.weight
        at = racks.setdefault(s.region, {})
        at[s.rack] = at.get(s.rack, 0) + s.weight
        leaves.setdefault((s.region, s.rack), {})[s.number] = s.weight
    if not any(w > 0 for w in regions.values()):
        raise ValueError("no shard has a weight")

    def by_parent(tree: dict, parent: Column) -> Column:
        pairs = [(F.lit(name), _children(children)) for name, children in tree.items() if any(w > 0 for w in children.values())]
        return F.element_at(F.create_map(*(c for pair in pairs for c in pair)), parent)

    region = _pick(key, "region", _children(regions))
    rack = _pick(key, "rack", by_parent(racks, region))
    named = {f"{r}/{k}": children for (r, k), children in leaves.items()}
    return _pick(key, "shard", by_parent(named, F.concat(region, F.lit("/"), rack)))


def shard(
    docs: DataFrame,
    shards: list[Shard],
    grown: list[Shard] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    slot_buckets: int = 1024,
) -> DataFrame:
    """(id, size, text_crc32, shard, slot, grown_shard) for every row; slots run from 0 in each shard.

    Slots need no sort of a whole shard: rows are numbered within (shard, hash bucket), and the
    buckets' counts, ``len(shards) * slot_buckets`` rows at most, are added up on their own.
    """
    key = [F.col(id_col)]
    text = text_or_empty(text_col)
    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            place(key, shards).cast("int").alias("shard"),
            (place(key, grown) if grown else F.lit(None)).cast("int").alias("grown_shard"),
        ).withColumn("bucket", F.pmod(F.xxhash64("id", "text_crc32", "size"), F.lit(slot_buckets)).cast("int")),
        "placed",
    )
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("start"))
    place_in = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id", "text_crc32", "size"))
    return (
        rows.withColumn("in_bucket", place_in)
        .join(F.broadcast(starts), ["shard", "bucket"])
        .select("id", "size", "text_crc32", "shard", (F.col("start") + F.col("in_bucket") - 1).alias("slot"), "grown_shard")
    )

