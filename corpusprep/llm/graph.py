"""Connected components of a table of links, in a few joins per round.

Large-star and small-star rounds alternate until nothing changes: each node's larger neighbours are
hooked to its smallest neighbour, then its smaller ones. Links only ever become fewer, and the number
of rounds grows with the logarithm of the longest chain. Every round is written to the shared
folder, which cuts the lineage; nothing comes to the driver but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.session import materialize


def _least(pairs: DataFrame) -> DataFrame:
    """Smallest of each node and its neighbours. Written, so that Spark may split the skewed join with a hub."""
    return materialize(pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")), "least")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    found = both.join(_least(both), "a").filter(F.col("b") > F.col("a"))
    return found.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    hooked = down.join(least, "a").filter(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hooked.union(least.select("a", F.col("least").alias("b"))).filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link to another.

    ``links`` has two columns of integers, in any direction and with repeats; links from a node to
    itself and links with a null are left out.
    """
    a, b = links.columns
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter(F.col("a") != F.col("b")).distinct()
    links = materialize(links, "links")
    mark = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == mark:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        mark = tuple(state)
        links = materialize(_small_star(materialize(_large_star(links), "links")), "links")
