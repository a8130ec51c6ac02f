"""A filter of bounded size in front of a join: rows that cannot match are not moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.session import materialize

#: Most words of 64 bits in a filter; as a table of (word, mask) it is some 25 MB.
MOST_WORDS = 1 << 20


def _place(key: Column, words: int) -> tuple[Column, Column]:
    h = F.xxhash64(F.lit("in front of a join"), key)
    return F.pmod(h, F.lit(words)), F.pmod(F.shiftrightunsigned(h, 40), F.lit(64)).cast("int")


def words_for(keys: int) -> int:
    """Words of a filter for so many keys: sixteen bits a key, as long as they fit."""
    return min(MOST_WORDS, 1 << max(4, (keys // 4).bit_length()))


def maybe_in(rows: DataFrame, column: str, keys: DataFrame, of: str, n_keys: int | None = None) -> DataFrame:
    """The ``rows`` whose ``column`` may be among the ``of`` of ``keys``: all that are, and few others.

    The keys are hashed into a table of at most ``MOST_WORDS`` rows, whatever the data, which is broadcast.
    Far more keys than that let more rows pass; the join behind the filter stays right.
    """
    words = words_for(keys.count() if n_keys is None else n_keys)
    word, bit = _place(F.col(of), words)
    bits = keys.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_mask"))
    word, bit = _place(F.col(column), words)
    marked = rows.withColumn("_word", word).join(F.broadcast(materialize(bits, "filter")), "_word")
    return marked.filter(F.getbit("_mask", bit) == 1).drop("_word", "_mask")
