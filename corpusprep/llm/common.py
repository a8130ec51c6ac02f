"""What several operators share: tables of a run, and the place of the package on the workers."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.session import materialize

#: Odd numbers whose powers make polynomial hashes.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_LEAST_POWERS, _MOST_POWERS = 1 << 16, 1 << 22
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Least and most words of 64 bits in the filters that keep rows from being moved for a join that they cannot match:
#: 8 and 134 million bits, as a table of (word, mask) 3 and 50 MB.
FILTER_WORDS = 1 << 17
MOST_FILTER_WORDS = 1 << 21


def on_workers(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package; a cluster gets it by ``--py-files``.

    Rows hold whole texts, so that Arrow batches of Spark's usual number of rows would be large.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, paths) if p)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _hashed(column: Column, words: int) -> tuple[Column, Column]:
    h = F.xxhash64(F.lit("filter"), column)
    return F.pmod(h, F.lit(words)), F.pmod(F.shiftrightunsigned(h, 32), F.lit(64)).cast("int")


def filter_words(ids: int) -> int:
    """Words of a filter for so many ids: 256 bits an id, within the bounds."""
    return min(MOST_FILTER_WORDS, max(FILTER_WORDS, 1 << (4 * ids).bit_length()))


def _marked(rows: DataFrame, id_col: str, ids: DataFrame, of: str, words: int | None) -> DataFrame:
    """``rows`` with ``_maybe``: whether their id may be among ``ids``.

    The ids are hashed into ``words`` words of 64 bits, by default as many as their number asks for. That table has
    no more rows than ``MOST_FILTER_WORDS``, whatever the data, so it is broadcast. Beyond some hundred million ids
    more and more rows are marked, which costs time only.
    """
    words = filter_words(ids.count()) if words is None else words
    word, bit = _hashed(F.col(of), words)
    bits = ids.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_mask"))
    word, bit = _hashed(F.col(id_col), words)
    marked = rows.withColumn("_word", word).join(F.broadcast(materialize(bits, "filter")), "_word", "left")
    return marked.withColumn("_maybe", F.coalesce(F.getbit("_mask", bit) == 1, F.lit(False))).drop("_word", "_mask")


def maybe_in(rows: DataFrame, ids: DataFrame, name: str, words: int | None = None) -> DataFrame:
    """The ``rows`` whose ``name`` may be among those of ``ids``: all that are, and few others."""
    return _marked(rows, name, ids, name, words).filter("_maybe").drop("_maybe")


def drop_rows(
    rows: DataFrame, dropped: DataFrame, id_col: str, of: str, also: Column | None = None, words: int | None = None, nulls: bool = False
) -> DataFrame:
    """The ``rows`` without those whose ``id_col`` is among ``dropped``'s ``of`` (and for which ``also`` holds).

    A null is among them only with ``nulls``.
    Only rows that may be dropped are moved. Sorted on both sides at every size, so that what is moved
    follows the input.
    """
    marked = _marked(rows, id_col, dropped, of, words)
    alike = F.col(id_col).eqNullSafe(F.col(of)) if nulls else F.col(id_col) == F.col(of)
    checked = marked.filter("_maybe").join(dropped.hint("merge"), alike if also is None else alike & also, "left_anti")
    return marked.filter(~F.col("_maybe")).union(checked).drop("_maybe")


def powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``size`` powers, or more, of a base and of its inverse modulo 2**64.

    A worker keeps one table for each base, of bounded size; longer ones are made when asked for.
    """
    found = _POWERS.get(which)
    if found is None or len(found[0]) < size:
        full = max(_LEAST_POWERS, 1 << (size - 1).bit_length())
        tables = []
        for base in (BASES[which], pow(BASES[which], -1, 1 << 64)):
            table = np.full(full, base, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table, out=table))
        found = (tables[0], tables[1])
        if full <= _MOST_POWERS:
            _POWERS[which] = found
    return found


_CACHES: dict[str, Callable[[], None]] = {"powers": _POWERS.clear}
_OWNER = ""


def cached_by(owner: str, clear: Callable[[], None]) -> None:
    """Register how the caches that an operator keeps in a worker process are emptied."""
    _CACHES[owner] = clear


def slices(batches: Iterable, owner: str, rows: int = 1024) -> Iterator:
    """The Arrow batches of a task in slices, so that few texts at once are Python's.

    A worker process serves tasks of several operators. What others have left in caches goes when the
    first task of ``owner`` begins.
    """
    global _OWNER
    if owner != _OWNER:
        for other, clear in _CACHES.items():
            if other != owner:
                clear()
        _OWNER = owner
        give_back()
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    give_back()


def give_back() -> None:
    """Return freed memory to the system. A worker process serves many tasks, and memory that allocators
    hold on to would add up beside the executor's."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
