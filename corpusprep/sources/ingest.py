"""Reading JSONL and text files with their source order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.text import is_string, or_empty, or_empty_any, strip_long
from corpusprep.operators import scan

# Source order of a line: file, then file split, then row. A split is read in one piece by one
# task, so the generated row number grows along it; across splits and files it need not.
ORDER = ("src_file", "src_block", "src_row")
SFT_FIELDS = ("instruction", "input", "output", "language")
# Spark's parser takes no more than this for one value, whatever its options say.
VARIANT_BYTES = 128 << 20
NO_LIMIT = str((1 << 31) - 1)


def split() -> Column:
    """The file split of a line: the bucket that goes with :data:`ORDER`."""
    return F.struct("src_file", "src_block")


def file_path() -> Column:
    """The path of a line's file as it is named on storage. Spark gives it as a URI, which sorts otherwise."""
    return F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))


def ordered_text(spark: SparkSession, paths: str | Sequence[str], line_sep: str | None = None) -> DataFrame:
    """Raw text records, lines by default, with their source order."""
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    return reader.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("value").alias("text"),
        file_path().alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_row"),
    )


def line_starts(spark: SparkSession, paths: str | Sequence[str], per_file: bool = True) -> DataFrame:
    """(src_file, src_block, first_row, first_line): of each file split, the row number of its first line, and
    that line's number in its file, or in all files one after the other, from 0 and counting blank lines."""
    cuts = ordered_text(spark, paths).groupBy("src_file", "src_block").agg(
        F.min("src_row").alias("first_row"), F.count(F.lit(1)).alias("_lines")
    )
    segment, order = (["src_file"], ["src_block"]) if per_file else ([], ["src_file", "src_block"])
    known = scan.before(cuts, segment, order, {"_lines": scan.SUM})
    return known.select("src_file", "src_block", "first_row", F.coalesce("_lines_before", F.lit(0)).alias("first_line"))


def with_line_number(rows: DataFrame, starts: DataFrame, name: str = "line_no") -> DataFrame:
    """``rows`` with the number of their line, by the ``line_starts`` of the files they were read from."""
    number = F.col("first_line") + F.col("src_row") - F.col("first_row")
    # One row for each split of a file goes to all tasks; the lines stay where they are.
    return rows.join(F.broadcast(starts), ["src_file", "src_block"]).withColumn(name, number).drop("first_line", "first_row")


def lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Stripped, non-empty text lines with their source order."""
    return ordered_text(spark, paths).withColumn("text", strip_long(F.col("text"))).filter(F.col("text") != "")


def parse_records(df: DataFrame, line: str, fields: str = "fields", keep_line: bool = False) -> DataFrame:
    """Replace JSON text by ``fields``, MAP<STRING, VARIANT>; null for anything but one JSON object.

    ``unreadable`` marks objects beyond the size that Spark can hold as a VARIANT, of which it cannot be
    said whether they are sound. A repeated key keeps its last value if the session allows repeats,
    as :func:`corpusprep.session.prepare` sets it.

    The line is parsed as the only item of a list, because Spark's parser stops after one value
    and would not see what follows it. Values keep their JSON types, which a fixed schema would
    silently turn into strings.
    """
    options = {
        "singleVariantColumn": "v",
        "allowSingleQuotes": "false",
        # The parser's own limits would turn deep or long values into malformed lines.
        "maxNestingDepth": NO_LIMIT,
        "maxNumLen": NO_LIMIT,
        "maxStringLen": NO_LIMIT,
    }

    def wrapped(start: str, end: str) -> Column:
        return F.from_json(F.concat(F.lit(start), F.col(line), F.lit(end)), "v variant", options)["v"]

    # A stray "]" after the object would close the list early; as an object member it cannot.
    sound = F.when(F.col(line).rlike("}\\s*\\]"), wrapped('{"v":', "}").isNotNull()).otherwise(True)
    alone = F.try_variant_get("_items", "$[1]", "variant").isNull()
    return (
        df.withColumn("_items", wrapped("[", "]"))
        .withColumn(fields, F.when(alone & sound, F.try_variant_get("_items", "$[0]", "map<string,variant>")))
        .withColumn("unreadable", F.col(fields).isNull() & (F.octet_length(line) >= VARIANT_BYTES) & F.col(line).startswith("{"))
        .drop("_items", *([] if keep_line else [line]))
    )


def jsonl(spark: SparkSession, paths: str | Sequence[str], strict: bool = False, keep_line: bool = False) -> DataFrame:
    """JSONL records as ``fields`` with their source order, and the line as ``text`` if it is to be kept.

    Blank lines are skipped and a bad line has null ``fields``. With ``strict`` any blank or bad
    line fails the job.
    """
    raw = ordered_text(spark, paths).withColumn("text", strip_long(F.col("text")))
    if not strict:
        return parse_records(raw.filter(F.col("text") != ""), "text", keep_line=keep_line)
    failed = F.raise_error(F.concat(F.lit("bad JSON line in "), F.col("src_file"))).cast("map<string,variant>")
    return parse_records(raw, "text", keep_line=keep_line).withColumn("fields", F.coalesce("fields", failed))


def sft_records(parsed: DataFrame, fields: str = "fields") -> DataFrame:
    """Typed instruction columns beside the whole record; ``malformed`` marks unusable rows.

    Falsy values count as empty. An instruction or output that is neither is malformed.
    """
    record = F.col(fields)
    language = F.when(is_string(record["language"]), F.try_variant_get(record["language"], "$", "string"))
    typed = parsed.select(
        *[c for c in parsed.columns if c not in SFT_FIELDS],
        or_empty(record["instruction"]).alias("instruction"),
        or_empty_any(record["input"]).alias("input"),
        or_empty(record["output"]).alias("output"),
        language.alias("language"),
    )
    usable = record.isNotNull() & F.col("instruction").isNotNull() & F.col("output").isNotNull()
    return typed.withColumn("malformed", ~usable)
