"""Exact duplicate removal where the first record in source order wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.text import WHITESPACE_CLASS, strip
from corpusprep.operators.ranks import sort_key


def normalized(text: Column) -> Column:
    """Text for keys that ignore case and white space: lower case, each run of white space one space, stripped."""
    return F.lower(strip(F.regexp_replace(text, f"[{WHITESPACE_CLASS}]+", " ")))


def first_rows(df: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """The ``order`` columns of the first row of every key.

    A grouped minimum: it combines on the map side, so a key with a third of all rows leaves each
    task as one row, and only key and order columns are shuffled.
    """
    firsts = df.groupBy(key.alias("_key")).agg(F.min(sort_key([F.col(c) for c in order])).alias("_first"))
    if len(order) == 1:
        return firsts.select(F.col("_first").alias(order[0]))
    return firsts.select(*[F.col(f"_first.k{i}").alias(c) for i, c in enumerate(order)])


def first_wins(df: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """Keep the first row of every key. The join is on the unique order columns, so it cannot skew."""
    return df.join(first_rows(df, key, order), list(order), "left_semi")


def mark_first(df: DataFrame, firsts: DataFrame, order: Sequence[str], name: str = "is_first") -> DataFrame:
    """Add whether a row is among ``firsts``, the result of :func:`first_rows`."""
    marked = df.join(firsts.withColumn(name, F.lit(True)), list(order), "left")
    return marked.withColumn(name, F.coalesce(F.col(name), F.lit(False)))
