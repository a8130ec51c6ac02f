"""Near-duplicate texts by an LSH forest over MinHash, confirmed on full shingle sets.

1. Each text becomes its set of word shingles (64-bit hashes, made for many texts at once in numpy) and
   a MinHash signature. Texts with equal sets are one node from here on.
2. The forest: every tree orders the signatures from another place on. Nodes that agree in a tree's
   first values are a region; a region with too many nodes is cut by more values, as often as needed, so
   that depth follows density. Inside a region the nodes with a long common prefix are compared by
   one bit of each signature value; what may be similar is joined, and only one row per node goes on.
   A region that stays large at full depth is joined as a whole. What deeper orders may have parted is
   made good: in a region that was cut, the nodes outside the largest family are compared with all.
3. Nodes joined in any tree are a family. Families get their full sets, and links are confirmed exactly:
   one node is compared with all others, then every node outside the largest class that has formed.
   A link between two classes has an end outside the largest one, so that no link is lost. Families
   too large for one task are cut into blocks, with the nodes to compare sent to each block.

Nothing emits all pairs of a group. The only chance is in step 2: a pair of similarity 0.8 agrees in
none of 24 trees of depth 3 with probability 3e-8, and fails the comparison by bits with 9e-7.

Defined results: a text without words, or null, has an empty set and links with nothing. With fewer
words than a shingle has, the whole text is its only shingle. Rows with equal sets are always in one
class, also when ids repeat; a class's id is its smallest one. Rows without an id are in no class and stay. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import drop_rows, maybe_in, powers, slices
from corpusprep.llm.embed_dedup import join_labels
from corpusprep.llm.graph import components
from corpusprep.session import materialize

VALUES = 128
TREES = 24
DEPTHS = (3, 6, 12)
REGION = 4096
#: Agreement in one bit per value that a pair of similarity 0.8 reaches but for one in ten million.
LEAST_BITS = 97
#: The least similarity that trees, depths and bits are set for.
LEAST_PERCENT = 80
BLOCK_BYTES = 1 << 17
FAMILY_SHINGLES = 1 << 21
LEADERS = 16

_HASH_BITS = 52  # the rest of a word holds the number of the text within its block


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random value of each byte with A-Z lower-cased, which bytes separate words, signature factors."""
    rng = np.random.default_rng(20)
    value = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
    value[65:91] = value[97:123]
    space = np.zeros(256, bool)
    space[[32, *range(9, 14)]] = True
    return value, space, rng.integers(1, 1 << 62, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted distinct shingle hashes of each text, one after the other."""
    value, space, _ = _tables()
    encoded = [(t or "").encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b" ".join(encoded) + b" ", np.uint8)
    power, inverse = powers(0, len(data) + 1)
    gap = space[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[data] * power[: len(data)], dtype=np.uint64)])
    word = _mix((sums[ends] - sums[starts]) * inverse[starts])
    bounds = np.concatenate([[0], np.cumsum([len(e) + 1 for e in encoded])])
    first = np.searchsorted(starts, bounds)  # the first word of each text
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    count = np.diff(first)
    # Every word starts a shingle, if enough words of its text follow; a short text has one of all its words.
    hashed = np.zeros(len(word), np.uint64)
    for k in range(width):
        ahead = np.zeros(len(word), np.uint64)
        rest = word[k:]  # none, where the whole block has no more words than that
        ahead[: len(rest)] = rest
        if k:
            beyond = np.arange(len(word)) + k >= first[owner + 1]
            ahead[beyond] = 0
        hashed = _mix(hashed + ahead + np.uint64(k + 1))
    place = np.arange(len(word)) - first[owner]
    good = (place + width <= count[owner]) | (place == 0)
    key = (owner[good].astype(np.uint64) << np.uint64(_HASH_BITS)) | (hashed[good] >> np.uint64(64 - _HASH_BITS))
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    offsets = np.searchsorted(key >> np.uint64(_HASH_BITS), np.arange(len(texts) + 1).astype(np.uint64))
    return key & np.uint64((1 << _HASH_BITS) - 1), offsets


def blocks(texts: list[str | None]):
    """(start, end) of runs of texts of about a block's bytes; no more texts than a hash has room for."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= BLOCK_BYTES or i - start >= (1 << 64 - _HASH_BITS) - 2:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The MinHash signature of each non-empty set, as 32-bit values; empty sets get zeros."""
    _, _, factors = _tables()
    out = np.zeros((len(offsets) - 1, VALUES), np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        at = offsets[full]
        for k, factor in enumerate(factors):
            out[full, k] = np.minimum.reduceat((hashes * factor) >> np.uint64(32), at)
    return out


def signed(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(id, node, n, signature); ``node`` is 64 bits of the digest of the set, null for an empty one."""
    read = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, "minhash"):
            texts = batch.column("text").to_pylist()
            node, n, signature = [], [], []
            for a, b in blocks(texts):
                hashes, offsets = shingle_sets(texts[a:b], width)
                values = signatures(hashes, offsets)
                for i in range(b - a):
                    own = hashes[offsets[i] : offsets[i + 1]]
                    n.append(len(own))
                    node.append(int.from_bytes(hashlib.sha256(own).digest()[:8], "little", signed=True) if len(own) else None)
                    signature.append(values[i].tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(signature, pa.binary())],
                names=["id", "node", "n", "signature"],
            )

    return read.mapInArrow(run, "id long, node long, n long, signature binary")


def _tree_rows(nodes: DataFrame, depth: int) -> DataFrame:
    """(tree, region, node, n, bits) of (node, n, signature[, tree]): the region is the hash of a tree's first values."""
    chosen = "tree" in nodes.columns

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(batch.num_rows, VALUES)
            bits = np.packbits((values >> np.uint32(7)) & np.uint32(1), axis=1)
            bits = pa.array([row.tobytes() for row in bits], pa.binary())
            tree_of = np.asarray(batch.column("tree")) if chosen else None
            for tree in range(TREES):
                at = np.flatnonzero(tree_of == tree) if chosen else np.arange(batch.num_rows)
                if not len(at):
                    continue
                region = np.full(len(at), tree + 1, np.uint64)
                for k in range(depth):
                    region = _mix(region + values[at, (tree * DEPTHS[0] + k) % VALUES].astype(np.uint64))
                rows = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), tree, np.int32)),
                        pa.array(region.view(np.int64)),
                        batch.column("node").take(rows),
                        batch.column("n").take(rows),
                        bits.take(rows),
                    ],
                    names=["tree", "region", "node", "n", "bits"],
                )

    return nodes.mapInArrow(run, "tree int, region long, node long, n long, bits binary")


def _alike(bits: np.ndarray, n: np.ndarray, label: np.ndarray, percent: int, split: int | None = None) -> np.ndarray:
    """Join what may be similar: enough bits in common, and sizes that allow it. With ``split``, only across it."""
    signs = (np.unpackbits(bits, axis=1).astype(np.float32) * 2) - 1
    rows = range(0, split if split is not None else len(signs), 1024)
    for a in rows:
        end = min(a + 1024, split) if split is not None else a + 1024
        for b in range(split if split is not None else a, len(signs), 1024):
            same = (signs[a:end] @ signs[b : b + 1024].T + VALUES) / 2
            x, y = np.nonzero(same >= LEAST_BITS)
            x, y = x + a, y + b
            fits = (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])) & (x != y)
            label = join_labels(label, x[fits], y[fits])
    return label


def _joined(node: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(label != np.arange(len(label)))
    return node[at], node[label[at]]


def _region_links(rows: DataFrame, percent: int) -> DataFrame:
    """(node, root) of regions of bounded size; rows come sorted by region, and regions may span batches."""

    def run(batches):
        import pyarrow as pa

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            region = np.asarray(held.column("region"))
            last = int(np.flatnonzero(region != region[-1])[-1]) + 1 if len(region) and region[0] != region[-1] else 0
            if last:
                yield from done(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield from done(held)

    def done(table):
        import pyarrow as pa

        region = np.asarray(table.column("region"))
        starts = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
        sizes = np.diff([*starts, len(region)])
        several = np.repeat(sizes > 1, sizes)
        if not several.any():
            return
        table = table.filter(pa.array(several))
        sizes = sizes[sizes > 1]
        node, n = np.asarray(table.column("node")), np.asarray(table.column("n"))
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(len(node), -1)
        out = []
        at = 0
        for size in sizes.tolist():
            part = slice(at, at + size)
            at += size
            if size == 2:
                a, b = part.start, part.start + 1
                agree = VALUES - int(np.bitwise_count(bits[a] ^ bits[b]).sum())
                if agree >= LEAST_BITS and 100 * min(n[a], n[b]) >= percent * max(n[a], n[b]):
                    out.append((node[b : b + 1], node[a : a + 1]))
            else:
                out.append(_joined(node[part], _alike(bits[part], n[part], np.arange(size), percent)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["node", "root"])

    return rows.select("region", "node", "n", "bits").mapInArrow(run, "node long, root long")


def _across_links(rows: DataFrame, links: DataFrame, percent: int, region: int) -> DataFrame:
    """(node, root) of what deeper orders may have parted in large regions.

    Two nodes that are in no common family yet, of which one is outside the region's largest family,
    are compared: every part of the nodes outside meets every block of the region in one task.
    """
    labelled = rows.join(components(links), "node", "left").select(
        "region", "node", "n", "bits", F.coalesce("component", "node").alias("family")
    )
    labelled = materialize(labelled, "large-regions")
    sizes = labelled.groupBy("region", "family").agg(F.count(F.lit(1)).alias("size"))
    most = sizes.groupBy("region").agg(F.max_by("family", F.struct("size", "family")).alias("family"), F.sum("size").alias("size"))
    half = max(1, region // 2)
    outside = labelled.join(materialize(most.select("region", "family"), "largest"), ["region", "family"], "left_anti")
    counts = outside.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / half).cast("int").alias("parts"))
    counts = materialize(counts.join(most, "region").select("region", "parts", F.ceil(F.col("size") / half).cast("int").alias("blocks")), "counts")

    def place(count: str):
        return F.pmod(F.xxhash64(F.lit(count), "node"), F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    asked = outside.join(counts, "region").withColumn("part", place("parts")).withColumn("block", every("blocks")).withColumn("asked", F.lit(1))
    others = labelled.join(counts, "region").withColumn("block", place("blocks")).withColumn("part", every("parts")).withColumn("asked", F.lit(0))
    columns = ["region", "block", "part", "asked", "node", "n", "bits"]

    def run(group):
        import pyarrow as pa

        asked = np.asarray(group.column("asked"))
        order = np.argsort(-asked, kind="stable")
        node, n = np.asarray(group.column("node"))[order], np.asarray(group.column("n"))[order]
        bits = np.frombuffer(b"".join(group.column("bits").to_pylist()), np.uint8).reshape(len(node), -1)[order]
        node, root = _joined(node, _alike(bits, n, np.arange(len(node)), percent, int(asked.sum())))
        return pa.table({"node": node, "root": root})

    return asked.select(columns).union(others.select(columns)).groupBy("region", "block", "part").applyInArrow(run, "node long, root long")


def forest_links(nodes: DataFrame, percent: int, region: int = REGION) -> DataFrame:
    """(node, root) over all trees; ``nodes`` has (node, n, signature) and is read once per depth."""
    spark = nodes.sparkSession
    found, parted, rest = [], None, nodes
    for depth in DEPTHS:
        rows = _tree_rows(rest, depth)
        # Regions over the bound: at most one for every ``region`` rows.
        large = materialize(rows.groupBy("region").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > region).select("region"), "large")
        if large.isEmpty():
            found.append(_region_links(_in_order(spark, rows), percent))
            break
        small = rows.join(large, "region", "left_anti")
        found.append(_region_links(_in_order(spark, small), percent))
        deeper = materialize(rows.join(large, "region", "left_semi"), "deeper")
        if depth == DEPTHS[-1]:
            # Alike in so many values: one family, which is confirmed as any other.
            roots = materialize(deeper.groupBy("region").agg(F.min("node").alias("root")), "roots")
            found.append(deeper.join(roots, "region").select("node", "root"))
            break
        parted = deeper if parted is None else parted
        rest = materialize(deeper.select("tree", "node").join(nodes, "node"), "descend")
    links = materialize(_all(found), "forest")
    return links if parted is None else links.union(_across_links(parted, links, percent, region))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _in_order(spark, rows: DataFrame) -> DataFrame:
    """All trees' orders, region by region; a region holds a bounded number of rows."""
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "region").sortWithinPartitions("region", "node")


class Sets:
    """Shingle sets of some nodes as one array, for comparing one of them with all others at once."""

    def __init__(self, hashes: np.ndarray, offsets: np.ndarray):
        self.offsets = offsets
        _, self.number = np.unique(hashes, return_inverse=True)
        self.size = np.diff(offsets)
        self.mark = np.zeros(int(self.number.max()) + 1 if len(self.number) else 0, np.int64)

    def linked(self, i: int, percent: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """The sets from ``start`` to ``end`` whose similarity with set ``i`` is at least ``percent``."""
        end = len(self.size) if end is None else end
        own = self.number[self.offsets[i] : self.offsets[i + 1]]
        self.mark[own] = 1
        a, b = self.offsets[start], self.offsets[end]
        both = np.add.reduceat(self.mark[self.number[a:b]], self.offsets[start:end] - a)
        self.mark[own] = 0
        union = self.size[start:end] + self.size[i] - both
        return np.flatnonzero(100 * both >= percent * union) + start


def classes(sets: Sets, percent: int) -> np.ndarray:
    """Label of each set's class: compare all that are outside the largest class, one after the other."""
    count = len(sets.size)
    label, done = np.arange(count), np.zeros(count, bool)
    while True:
        size = np.bincount(label, minlength=count)
        todo = np.flatnonzero(~done & (label != size.argmax()))
        if not done.any():
            todo = np.array([0])
        if not len(todo):
            return label
        i = int(todo[0])
        done[i] = True
        linked = sets.linked(i, percent)
        label = join_labels(label, np.full(len(linked), i), linked)


def _sets_of(table) -> Sets:
    sets = table.column("set").to_pylist()
    offsets = np.concatenate([[0], np.cumsum([len(x) // 8 for x in sets])])
    return Sets(np.frombuffer(b"".join(sets), np.uint64), offsets)


def _member_sets(docs: DataFrame, members: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(family, total, node, set) of the nodes in ``members`` (family, total, node, least)."""
    texts = docs.select(docs[id_col].cast("long").alias("least"), docs[text_col].cast("string").alias("text"))
    # Sorted on both sides at every size, so that what is moved follows the input.
    read = maybe_in(texts, members, "least").join(members.hint("merge"), "least")

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, "minhash"):
            texts, nodes = batch.column("text").to_pylist(), batch.column("node").to_pylist()
            found = []
            for a, b in blocks(texts):
                hashes, offsets = shingle_sets(texts[a:b], width)
                for i in range(a, b):
                    own = hashes[offsets[i - a] : offsets[i - a + 1]]
                    # Where an id repeats with another text, that row is another node.
                    same = int.from_bytes(hashlib.sha256(own).digest()[:8], "little", signed=True) == nodes[i]
                    found.append(own.tobytes() if same else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("family"), batch.column("total"), batch.column("node"), pa.array(found, pa.binary())],
                names=["family", "total", "node", "set"],
            )

    found = read.select("family", "total", "node", "text").mapInArrow(run, "family long, total long, node long, set binary")
    return found.filter(F.col("set").isNotNull())


def _confirm_small(members: DataFrame, percent: int, buckets: int) -> DataFrame:
    """(node, root) of families that fit a task; many of them share one."""

    def run(table):
        import pyarrow as pa

        table = table.combine_chunks().sort_by([("family", "ascending"), ("node", "ascending")])
        family, node = np.asarray(table.column("family")), np.asarray(table.column("node"))
        starts = np.flatnonzero(np.concatenate([[True], family[1:] != family[:-1]]))
        out = []
        for a, b in zip(starts, [*starts[1:], len(family)]):
            out.append(_joined(node[a:b], classes(_sets_of(table.slice(a, b - a)), percent)))
        return pa.table({"node": np.concatenate([o[0] for o in out]), "root": np.concatenate([o[1] for o in out])})

    bucket = F.pmod(F.xxhash64("family"), F.lit(buckets))
    return members.select(bucket.alias("bucket"), "family", "node", "set").groupBy("bucket").applyInArrow(run, "node long, root long")


def _confirm_asked(members: DataFrame, asked: DataFrame, percent: int, weight: int) -> DataFrame:
    """(node, root): links of the ``asked`` nodes with all members of their families.

    ``members`` has (family, blocks, block, node, set). The asked nodes of a family are cut into parts
    of bounded size, and each part meets each block of the family in one task.
    """
    ask = members.join(asked, "node", "left_semi")
    parts = ask.groupBy("family").agg(F.ceil(F.sum(F.octet_length("set")) / (8 * weight)).cast("int").alias("parts"))
    ask = (
        ask.join(parts, "family")
        .withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "node"), F.col("parts")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    rest = members.join(parts, "family").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    both = ask.withColumn("asked", F.lit(1)).select("family", "block", "part", "asked", "node", "set").union(
        rest.withColumn("asked", F.lit(0)).select("family", "block", "part", "asked", "node", "set")
    )

    def run(table):
        import pyarrow as pa

        table = table.combine_chunks().sort_by([("asked", "descending"), ("node", "ascending")])
        node, split = np.asarray(table.column("node")), int(np.asarray(table.column("asked")).sum())
        sets, label = _sets_of(table), np.arange(len(node))
        if split < len(node):
            for i in range(split):
                linked = sets.linked(i, percent, split)
                label = join_labels(label, np.full(len(linked), i), linked)
        node, root = _joined(node, label)
        return pa.table({"node": node, "root": root})

    return both.groupBy("family", "block", "part").applyInArrow(run, "node long, root long")


def _confirm_large(members: DataFrame, percent: int, weight: int, leaders: int = LEADERS) -> DataFrame:
    """(node, root) of families of any size: a few leaders first, then all nodes outside the largest class."""
    members = materialize(
        members.withColumn("blocks", F.ceil(F.col("total") / weight).cast("int")).select(
            "family", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), "node", "set"
        ),
        "large-families",
    )
    draw = F.xxhash64(F.lit("leader"), "node")
    chosen = members.groupBy("family", F.pmod(draw, F.lit(leaders)).alias("seat")).agg(F.min_by("node", draw).alias("node"))
    first = materialize(_confirm_asked(members, materialize(chosen.select("node"), "leaders"), percent, weight), "by-leaders")
    placed = members.select("family", "node").join(components(first), "node", "left").select(
        "family", "node", F.coalesce("component", "node").alias("component")
    )
    placed = materialize(placed, "placed")
    most = placed.groupBy("family", "component").agg(F.count(F.lit(1)).alias("size")).groupBy("family").agg(
        F.max_by("component", F.struct("size", "component")).alias("component")
    )
    outside = placed.join(most, ["family", "component"], "left_anti").join(chosen, "node", "left_anti").select("node")
    return first.union(_confirm_asked(members, materialize(outside, "outside"), percent, weight))


def near(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    region: int = REGION,
    weight: int = FAMILY_SHINGLES,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row.

    ``width`` words make a shingle; texts link when ``100 * intersection >= percent * union``. ``region``
    bounds the nodes that are compared in one task, ``weight`` the shingles.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"pairs below {LEAST_PERCENT} % would be lost without a word: the forest is set for that, not {percent} %")
    rows = materialize(signed(docs, width, id_col, text_col), "signed")
    groups = materialize(
        rows.filter(F.col("node").isNotNull() & F.col("id").isNotNull())
        .groupBy("node")
        .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("count"), F.max("n").alias("n"), F.max("signature").alias("signature")),
        "nodes",
    )
    links = materialize(forest_links(groups.select("node", "n", "signature"), percent, region), "forest")
    family = components(links).select("node", F.col("component").alias("family"))
    narrow = materialize(family.join(groups.select("node", "least", "n"), "node"), "families")
    totals = narrow.groupBy("family").agg(F.sum("n").alias("total"))
    members = materialize(_member_sets(docs, narrow.select("family", "node", "least").join(totals, "family"), width, id_col, text_col), "members")
    shingles = narrow.agg(F.sum("n")).first()[0] or 0
    small = _confirm_small(members.filter(F.col("total") <= weight), percent, max(1, -(-4 * shingles // weight)))
    large = members.filter(F.col("total") > weight)
    confirmed = small if large.isEmpty() else small.union(_confirm_large(large, percent, weight))
    member = components(confirmed)
    smallest = member.join(groups.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_id"))
    # Nodes with a link or with several rows; all other rows are on their own.
    known = materialize(
        groups.select("node", "least", "count")
        .join(member, "node", "left")
        .join(smallest, "component", "left")
        .filter((F.col("count") > 1) | F.col("component_id").isNotNull())
        .select("node", F.coalesce("component_id", "least").alias("component_id")),
        "classes",
    )
    own = F.coalesce("component_id", "id")
    return rows.select("id", "node", "n").join(known, "node", "left").select(
        "id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), own).alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == own)).alias("kept"),
    )


def keep(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, without those whose class has a smaller id."""
    dropped = f"{id_col}_of_dropped"
    found = near(docs, width, percent, id_col, text_col).groupBy("id").agg(F.max("kept").alias("kept")).filter(~F.col("kept"))
    return drop_rows(docs, materialize(found.select(F.col("id").alias(dropped)), "dropped"), id_col, dropped)
