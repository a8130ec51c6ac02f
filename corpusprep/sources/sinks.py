"""Writers. Every sink is a directory that Spark's tasks fill in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.sources.ingest import parse_records


#: Text in one range of a table that is written in order.
RANGE_BYTES = 64 << 20


def in_order(df: DataFrame, *order: str, least: int = 1, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``df`` in the given order, in as many ranges as its texts ask for, ``least`` or more: one file each."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.simpleString() == "string"]
    size = sum(texts, F.lit(0).cast("long"))
    ranges = df.agg(F.ceil(F.sum(size) / range_bytes).cast("long")).first()[0] or 0
    return df.repartitionByRange(max(least, ranges), *order).sortWithinPartitions(*order)


def jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per row, as UTF-8; explicit nulls are kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def text(df: DataFrame, path: str, column: str = "text", mode: str = "errorifexists") -> None:
    """One line per row."""
    df.select(column).write.mode(mode).text(path)


def splits(df: DataFrame, path: str, column: str = "split", mode: str = "errorifexists") -> None:
    """JSONL in one sub-directory per split, written in a single pass."""
    df.write.mode(mode).partitionBy(column).option("ignoreNullFields", "false").json(path)


def record_json(line: Column, fields: Column, n_tokens: Column) -> Column:
    """The line of a record that is not empty as it came, with its ``n_tokens``.

    Numbers, escapes and the order of fields stay as they are. Only a record that brings a field
    ``n_tokens`` of its own, by its ``fields``, is written anew, with that field replaced.
    """
    value = F.coalesce(n_tokens.cast("string"), F.lit("null"))
    extended = F.concat(F.substr(line, F.lit(1), F.length(line) - 1), F.lit(', "n_tokens": '), value, F.lit("}"))
    others = F.map_filter(fields, lambda k, _: k != "n_tokens")
    anew = F.to_json(F.map_concat(others, F.create_map(F.lit("n_tokens"), n_tokens.cast("variant"))))
    return F.when(F.map_contains_key(fields, F.lit("n_tokens")), anew).otherwise(extended)


def record_lines(lines: DataFrame, marks: DataFrame, order: Sequence[str], split_at: Sequence[str], line: str = "text") -> DataFrame:
    """(split, value, order) of the lines of JSONL records that have a mark, with every field they came with.

    ``marks`` has ``order``, ``split`` and ``n_tokens``, a row for each line that goes out; ``split_at`` names the columns
    of ``order`` that say which piece of a file a line came from. Lines and marks are moved once and together, by ranges
    of pieces; there each line meets its mark. Partitions are in source order, and rows in them by split and source order.
    Only lines that may have a field ``n_tokens`` of their own are parsed.
    """
    nothing = F.lit(None)
    both = lines.select(*order, F.col(line).alias("_line"), nothing.cast("string").alias("split"), nothing.cast("int").alias("n_tokens")).unionByName(
        marks.select(*order, nothing.cast("string").alias("_line"), "split", F.col("n_tokens").cast("int").alias("n_tokens"))
    )
    # All rows of a piece come into one partition, so that grouping by place moves nothing more.
    met = both.repartitionByRange(*split_at).groupBy(*order).agg(*[F.max(c).alias(c) for c in ("_line", "split", "n_tokens")])
    # An escape may hide the name of a field.
    suspect = F.col("_line").contains("n_tokens") | F.col("_line").contains("\\u")
    parsed = parse_records(met.filter(F.col("split").isNotNull()).withColumn("_suspect", F.when(suspect, F.col("_line"))), "_suspect")
    value = record_json(F.col("_line"), F.col("fields"), F.col("n_tokens")).alias("value")
    return parsed.select("split", value, *order).sortWithinPartitions("split", *order)


def record_splits(lines: DataFrame, marks: DataFrame, path: str, order: Sequence[str], split_at: Sequence[str], line: str = "text", mode: str = "errorifexists") -> None:
    """As :func:`splits`, for the lines of :func:`record_lines`. Files are numbered, and lines written, in source
    order, so that readers of a split find it again: the writer has nothing to sort."""
    record_lines(lines, marks, order, split_at, line).select("split", "value").write.mode(mode).partitionBy("split").text(path)


def by_category(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Evaluation results, one sub-directory per category."""
    df.write.mode(mode).partitionBy("category").option("ignoreNullFields", "false").json(path)
