"""Counts over classified, split and converted records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.text import WHITESPACE_CLASS
from corpusprep.functions.tokenizers import NativeTokenizer, Tokenizer
from corpusprep.operators import scan
from corpusprep.operators.split import THREE_WAY
from corpusprep.operators.validate import STATUSES, UNREADABLE

UNKNOWN_LANGUAGE = "unknown"
# Fixed value: a corpus below this is not worth continued training.
LEAST_CORPUS_TOKENS = 200_000


def status_counts(classified: DataFrame) -> DataFrame:
    """One row: total, one count per status, and the token sum of over-long counted records."""
    too_long = F.col("status") == "too_long"
    return classified.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        F.coalesce(F.sum(F.when(too_long, F.col("n_tokens").cast("bigint"))), F.lit(0)).alias("too_long_tokens_sum"),
    )


def running_by_file(classified: DataFrame, file: str) -> DataFrame:
    """Status counts per file, added up along the sorted file names."""
    names = ("total", *STATUSES)
    per_file = classified.groupBy(file).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    )
    known = scan.before(per_file, [], [file], dict.fromkeys(names, scan.SUM))
    return known.select(file, *[(F.col(c) + F.coalesce(F.col(f"{c}_before"), F.lit(0))).alias(c) for c in names])


def split_counts(split: DataFrame, names: Sequence[str] = THREE_WAY) -> DataFrame:
    """One row: rows per split and in total."""
    return split.agg(
        *[F.count_if(F.col("split") == n).alias(n) for n in names], F.count(F.lit(1)).alias("total")
    )


def language_dist(split: DataFrame) -> DataFrame:
    """Rows per language in the training split."""
    return (
        split.filter(F.col("split") == "train")
        .groupBy(F.coalesce("language", F.lit(UNKNOWN_LANGUAGE)).alias("language"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def lcpt_counts(lines: DataFrame) -> DataFrame:
    """One row: kept, total and over-long text lines."""
    return lines.agg(
        F.count_if(F.col("status") == "valid").alias("kept"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "too_long").alias("too_long"),
    )


# Bytes that texts with other white space than the native tokenizer's have among theirs.
_RARE_SPACE = ("1C", "1D", "1E", "1F", "C285", "C2A0", "E19A80", "E280", "E281", "E38080")


def _n_words(text: Column) -> Column:
    """Runs of characters that are no white space; a null text has none to speak of.

    Most texts are cut as the native tokenizer cuts them, which is then done once for both.
    """

    def count(cut: Column) -> Column:
        return F.aggregate(cut, F.lit(0).cast("bigint"), lambda n, word: n + (word != "").cast("bigint"))

    rare = reduce(or_, [F.contains(text.cast("binary"), F.unhex(F.lit(b))) for b in _RARE_SPACE])
    return F.when(rare, count(F.split(text, f"[{WHITESPACE_CLASS}]+"))).otherwise(count(F.split(text, f"[{NativeTokenizer.SPACES}]+")))


def fertility(df: DataFrame, text: str, group: str, tokenizer: Tokenizer | None = None) -> DataFrame:
    """Characters per token and tokens per word of each group, from sums over all its texts."""
    counted = df.select(
        group,
        F.length(text).cast("bigint").alias("_chars"),
        (tokenizer or NativeTokenizer()).count(F.col(text)).cast("bigint").alias("_tokens"),
        _n_words(F.col(text)).alias("_words"),
    )
    sums = counted.groupBy(group).agg(*[F.coalesce(F.sum(f"_{c}"), F.lit(0)).alias(f"n_{c}") for c in ("chars", "tokens", "words")])
    return sums.withColumns(
        {
            "chars_per_token": F.round(F.try_divide("n_chars", "n_tokens"), 6),
            "tokens_per_word": F.round(F.try_divide("n_tokens", "n_words"), 6),
        }
    )


def token_budget(df: DataFrame, text: str, least: int = LEAST_CORPUS_TOKENS, tokenizer: Tokenizer | None = None) -> DataFrame:
    """One row: the tokens of a corpus, and whether they are enough for continued training."""
    tokens = F.coalesce(F.sum((tokenizer or NativeTokenizer()).count(F.col(text)).cast("bigint")), F.lit(0))
    return df.agg(tokens.alias("n_tokens")).withColumn("enough", F.col("n_tokens") >= least)


def build(
    classified: DataFrame,
    split: DataFrame,
    lcpt: DataFrame,
    tokenizer_vocab_size: int | None = None,
    wall_time_seconds: float | None = None,
    tokenizer: str | None = None,
) -> DataFrame:
    """The validation report as one row, from records, split records and judged text lines.

    ``tokenizer`` names what counted the tokens of borderline texts.
    """
    counts = status_counts(classified)
    unreadable = classified.agg(F.count_if(F.col("status") == UNREADABLE).alias("n"))
    splits = split_counts(split).select(
        F.create_map(*[x for n in (*THREE_WAY, "total") for x in (F.lit(n), F.col(n))])
    )
    languages = language_dist(split).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("language", "n_rows")))))
    return counts.select(
        F.col("total").alias("total_rows_read"),
        "malformed",
        unreadable.scalar().alias("unreadable"),
        "empty_fields",
        F.col("duplicates").alias("duplicates_removed"),
        "valid",
        "too_long",
        splits.scalar().alias("splits"),
        lcpt_counts(lcpt).select("kept").scalar().alias("lcpt_kept"),
        languages.scalar().alias("language_distribution"),
        F.lit(tokenizer).cast("string").alias("tokenizer"),
        F.lit(tokenizer_vocab_size).cast("int").alias("tokenizer_vocab_size"),
        F.bround(F.lit(wall_time_seconds).cast("double"), 1).alias("wall_time_seconds"),
    )
