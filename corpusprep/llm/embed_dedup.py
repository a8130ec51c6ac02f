"""Near-duplicate embeddings: cosine links by int8 tile products with rigorous error bounds.

Equal vectors are first brought together (map-side), so that a vector that makes up much of the table
is compared once. The distinct ones are dealt into bands by hash, and every two bands meet in one task
of bounded size. There the vectors, scaled to length 1, are quantised to int8; products of tiles
of int8 values are exact, and for a pair with quantisation errors of length ``e`` and ``f`` the
cosine differs from the scaled product by ``e + f + e f`` at most. Only pairs that may reach the
threshold within that bound are computed again in double precision. A tile returns no pairs: it adds
up each vector's links and joins linked vectors by union-find, and returns one row per linked vector.

The number of tile products grows with the square of the distinct vectors, as comparing all of them by
cosine does; the shuffle grows with vectors times bands.

Defined results: a vector that is null, has length 0, or holds a null or non-finite component links
with nothing, and neither do vectors of different dimension link. Rows with equal vectors link with
each other, each row counting, also where an id repeats; a group in which no row has an id has a null
component. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.graph import components
from corpusprep.session import materialize

BAND = 4096
TILE = 1024


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values as floats, scale, length of the error) of unit vectors.

    Products of such values are whole numbers. They are exact in single precision up to 1,040
    dimensions, beyond that double precision is used.
    """
    scale = np.abs(unit).max(1) / 127
    q = np.rint(unit / scale[:, None])
    # A little more than the computed length, for the rounding of this very computation.
    error = np.linalg.norm(unit - q * scale[:, None], axis=1) * (1 + 1e-9) + 1e-12
    exact = np.float32 if unit.shape[1] * 127 * 127 < 1 << 24 else np.float64
    return q.astype(np.int8).astype(exact), scale, error


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool = False):
    """Yield (i, j) arrays of the pairs of unit vectors with cosine at or above the threshold, tile by tile.

    With ``same``, ``a`` and ``b`` are one set and each pair comes once, with i < j.
    """
    qa, sa, ea = quantise(a)
    qb, sb, eb = (qa, sa, ea) if same else quantise(b)
    for i in range(0, len(a), TILE):
        for j in range(i if same else 0, len(b), TILE):
            at, bt = slice(i, i + TILE), slice(j, j + TILE)
            estimate = (qa[at] @ qb[bt].T) * sa[at, None] * sb[None, bt]
            bound = ea[at, None] + eb[None, bt] + ea[at, None] * eb[None, bt] + 1e-9
            x, y = np.nonzero(estimate >= threshold - bound)
            if same and i == j:
                x, y = x[x < y], y[x < y]
            for k in range(0, len(x), 1 << 16):
                p, q = x[k : k + (1 << 16)] + i, y[k : k + (1 << 16)] + j
                sure = np.einsum("ij,ij->i", a[p], b[q]) >= threshold
                if sure.any():
                    yield p[sure], q[sure]


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the sets that each link (a, b) connects; ``label`` points at the smallest place of a set."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(x[apart], y[apart]), np.minimum(x[apart], y[apart]))
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label = shorter


def _unit_rows(column) -> tuple[list[bytes | None], list[int]]:
    """Each vector scaled to length 1, as bytes of doubles; None for one that links with nothing."""
    units, dims = [], []
    for value in column.to_pylist():
        unit, dim = None, 0
        if value and None not in value:
            v = np.asarray(value, np.float64)
            if np.isfinite(v).all() and v.any():
                v = v / np.abs(v).max()
                unit, dim = (v / np.sqrt(v @ v)).tobytes(), len(v)
        units.append(unit)
        dims.append(dim)
    return units, dims


def units(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, node, dim, unit): ``node`` is 64 bits of the digest of the unit vector, null if there is none."""
    read = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("vector"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            unit, dim = _unit_rows(batch.column("vector"))
            node = [None if u is None else int.from_bytes(hashlib.sha256(u).digest()[:8], "little", signed=True) for u in unit]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(node, pa.int64()), pa.array(dim, pa.int32()), pa.array(unit, pa.binary())],
                names=["id", "node", "dim", "unit"],
            )

    return read.mapInArrow(run, "id long, node long, dim int, unit binary")


def tile_links(distinct: DataFrame, bands: int, threshold: float) -> DataFrame:
    """(node, links, root) of every node linked in a pair of bands; ``distinct`` has (node, dim, unit, n)."""
    own = F.pmod(F.xxhash64("node"), F.lit(bands)).cast("int")
    met = (
        distinct.withColumn("band", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))))
        .withColumn("low", F.least("band", "other"))
        .withColumn("high", F.greatest("band", "other"))
        .select("dim", "low", "high", "band", "node", "n", "unit")
    )

    def run(group):
        import pyarrow as pa

        group = group.combine_chunks()
        node = group.column("node").to_numpy()
        n = group.column("n").to_numpy()
        order = np.lexsort((node, group.column("band").to_numpy()))
        unit = np.frombuffer(b"".join(group.column("unit").to_pylist()), np.float64).reshape(len(node), -1)[order]
        node, n = node[order], n[order]
        low = group.column("low")[0].as_py()
        split = int((group.column("band").to_numpy() == low).sum())
        same = group.column("high")[0].as_py() == low
        label, links = np.arange(len(node)), np.zeros(len(node), np.int64)
        if same:
            found = linked_pairs(unit, unit, threshold, same=True)
        else:
            found = ((i, j + split) for i, j in linked_pairs(unit[:split], unit[split:], threshold))
        for i, j in found:
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            label = join_labels(label, i, j)
        at = np.flatnonzero(links)
        return pa.table({"node": node[at], "links": links[at], "root": node[label[at]]})

    return met.groupBy("dim", "low", "high").applyInArrow(run, "node long, links long, root long")


def link(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", band: int = BAND) -> DataFrame:
    """(id, n_links, component_id, kept) for every row."""
    rows = materialize(units(vectors, id_col, vector_col), "units")
    groups = materialize(
        rows.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim"), F.max("unit").alias("unit")),
        "distinct",
    )
    bands = max(1, -(-groups.count() // band))
    found = materialize(tile_links(groups.select("node", "dim", "unit", "n"), bands, threshold), "tiles")
    member = components(found.select("node", "root"))
    named = member.join(groups.select("node", "least"), "node")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    # Nodes with a link or with several rows; all other rows are on their own.
    known = materialize(
        groups.select("node", "least", "n")
        .join(links, "node", "left")
        .join(member, "node", "left")
        .join(smallest, "component", "left")
        .filter((F.col("n") > 1) | F.col("links").isNotNull())
        .select(
            "node",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "least").alias("component_id"),
            F.lit(True).alias("linked"),
        ),
        "known",
    )
    component_id = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("id"))
    return rows.select("id", "node").join(known, "node", "left").select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        F.col("id").eqNullSafe(component_id).alias("kept"),
    )
