"""The status waterfall over instruction records, and the same limits for plain text lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.hashing import pair_digest
from corpusprep.functions.text import n_chars, strip, strip_long, text_or_empty
from corpusprep.functions.tokenizers import NativeTokenizer, Tokenizer
from corpusprep.operators.dedup import first_rows, mark_first

# Fixed values.
CHARS_PER_TOKEN_LOW = 2.0
CHARS_PER_TOKEN_HIGH = 5.0
MAX_RECORD_TOKENS = 1024
MAX_LINE_TOKENS = 2048
MIN_INSTRUCTION_CHARS = 3
MIN_OUTPUT_CHARS = 2
MIN_LINE_CHARS = 10
STATUSES = ("malformed", "empty_fields", "duplicates", "valid", "too_long")
BORDERLINE = "borderline"
# Not a fixed value: lines that Spark's parser cannot hold, counted apart from those that are no JSON.
UNREADABLE = "unreadable"


def prompt_text(instruction: Column, input_: Column, output: Column | None = None) -> Column:
    """The text whose length is limited: instruction and input, and output only on request."""
    return strip(_joined(instruction, input_, output))


def _joined(*parts: Column | None) -> Column:
    return F.concat_ws(" ", *[text_or_empty(c) for c in parts if c is not None])


def with_prompt(df: DataFrame, include_output: bool = False) -> DataFrame:
    """Add ``_prompt`` as :func:`prompt_text`, and its length ``_chars``."""
    joined = _joined(F.col("instruction"), F.col("input"), F.col("output") if include_output else None)
    # The join of the parts is a column of its own, because strip_long names its column many times.
    return (
        df.withColumn("_prompt", joined)
        .withColumn("_prompt", strip_long(F.col("_prompt")))
        .withColumn("_chars", n_chars(F.col("_prompt")))
    )


def length_class(
    n: Column, max_tokens: int, low: float = CHARS_PER_TOKEN_LOW, high: float = CHARS_PER_TOKEN_HIGH
) -> Column:
    """Judge a text by its length in characters: ``valid``, ``too_long``, or ``borderline`` (needs tokens)."""
    return F.when(n <= max_tokens * low, "valid").when(n > max_tokens * high, "too_long").otherwise(BORDERLINE)


def token_limit(
    df: DataFrame, text: Column, state: str, max_tokens: int, tokenizer: Tokenizer, n_tokens: str = "n_tokens"
) -> DataFrame:
    """Settle the rows whose ``state`` is borderline by their token count.

    The gate is inside the tokenizer's argument: other rows hand it a null, so a Python tokenizer
    receives no text for them, and no second pass over the data is needed.
    """
    borderline = F.col(state) == BORDERLINE
    counted = df.withColumn(n_tokens, tokenizer.count(F.when(borderline, text)).cast("int"))
    return counted.withColumn(
        state,
        F.when(F.col(state) != BORDERLINE, F.col(state))
        .when(F.col(n_tokens) <= max_tokens, "valid")
        .otherwise("too_long"),
    )


def early_status(df: DataFrame) -> Column:
    """``unreadable``, ``malformed`` and ``empty_fields``; null for rows that go on."""
    malformed = F.col("malformed") if "malformed" in df.columns else F.lit(False)
    unreadable = F.col(UNREADABLE) if UNREADABLE in df.columns else F.lit(False)

    # strip() and not strip_long(): this test is pushed down as a filter, where the columns may
    # stand for costly expressions.
    short = (F.length(strip(text_or_empty(F.col("instruction")))) < MIN_INSTRUCTION_CHARS) | (
        F.length(strip(text_or_empty(F.col("output")))) < MIN_OUTPUT_CHARS
    )
    return F.when(unreadable, UNREADABLE).when(malformed, "malformed").when(short, "empty_fields")


def classify(
    df: DataFrame,
    order: Sequence[str],
    tokenizer: Tokenizer | None = None,
    max_tokens: int = MAX_RECORD_TOKENS,
    row_id: Sequence[str] | None = None,
    low: float = CHARS_PER_TOKEN_LOW,
    high: float = CHARS_PER_TOKEN_HIGH,
    exact: bool = False,
    include_output: bool = False,
) -> DataFrame:
    """Give every record exactly one status, and ``n_tokens`` where tokens had to be counted.

    ``df`` has instruction, input and output, and optionally a boolean ``malformed``; ``order``
    names columns that are unique and sort in source order; generated row numbers should be
    materialized before, because the records are read twice. ``row_id`` may name fewer of them that
    are unique by themselves. The tests run in the order malformed,
    empty_fields, duplicates, length, so a repeat of an over-long record is a duplicate. ``exact``
    counts tokens for every record instead of trusting the character limits.
    """
    tokenizer = tokenizer or NativeTokenizer()
    keyed = df.withColumn("_early", early_status(df))
    passed = F.col("_early").isNull()
    # Rejected rows take no part in the grouping.
    firsts = first_rows(keyed.filter(passed), pair_digest(F.col("instruction"), F.col("output")), order)
    # Lengths are settled before the join, so that no text has to go through it for the statuses.
    sized = with_prompt(keyed, include_output)
    length_state = F.lit(BORDERLINE) if exact else length_class(F.col("_chars"), max_tokens, low, high)
    judged = token_limit(
        sized.withColumn("status", F.coalesce("_early", length_state)), F.col("_prompt"), "status", max_tokens, tokenizer
    ).drop("_prompt", "_chars")
    repeat = passed & ~F.col("_first")
    return (
        mark_first(judged, firsts.select(*(row_id or order)), row_id or order, "_first")
        .withColumn("status", F.when(repeat, "duplicates").otherwise(F.col("status")))
        .withColumn("n_tokens", F.when(~repeat, F.col("n_tokens")))
        .drop("_early", "_first")
    )


def valid_records(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("status") == "valid").drop("status", "malformed", UNREADABLE)


def lcpt_lines(
    lines: DataFrame,
    text: str = "text",
    tokenizer: Tokenizer | None = None,
    max_tokens: int = MAX_LINE_TOKENS,
    min_chars: int = MIN_LINE_CHARS,
) -> DataFrame:
    """Status ``valid`` or ``too_long`` for text lines; lines under ``min_chars`` are dropped uncounted."""
    stripped = lines.withColumn(text, strip_long(F.col(text))).withColumn("_chars", n_chars(F.col(text)))
    staged = stripped.filter(F.col("_chars") >= min_chars).withColumn("status", length_class(F.col("_chars"), max_tokens))
    return token_limit(staged, F.col(text), "status", max_tokens, tokenizer or NativeTokenizer()).drop("_chars")
